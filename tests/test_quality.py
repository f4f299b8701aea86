import pytest

from flowline.operators.quality import schema_version_diff, validate_components
from flowline.sources.flow_xml import PARSED_SCHEMA

PROCESSOR = {
    "kind": "processor", "group_depth": 1, "id": "p", "name": "n", "class": "c", "scheduled_state": "RUNNING",
    "scheduling_period": "0 sec", "penalization_period": "30 sec", "yield_period": "1sec", "bulletin_level": "WARN",
    "max_concurrent_tasks": "1", "loss_tolerant": "false", "properties": {"Key": None},
}
SERVICE = {"kind": "controllerService", "group_depth": 1, "id": "s", "name": "S", "class": "c", "enabled": "true"}
REMOTE = {"kind": "remoteProcessGroup", "group_depth": 1, "id": "r", "name": "", "url": "", "timeout": "", "transmitting": "0"}
CONNECTION = {
    "kind": "connection", "group_depth": 1, "id": "c", "name": "", "source_id": "a", "source_group_id": "g",
    "source_type": "PROCESSOR", "destination_id": "b", "destination_group_id": "h", "destination_type": "PROCESSOR",
    "relationships": [""], "max_work_queue_size": "0",
}
PORT = {"kind": "inputPort", "group_depth": 0, "id": "i", "name": "in", "scheduled_state": "RUNNING", "max_concurrent_tasks": "1"}


@pytest.fixture
def components(spark):
    fields = [f for f in PARSED_SCHEMA.fields if f.name not in ("path", "reject_reason")]
    ddl = "flow_id string, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def build(*items):
        return spark.createDataFrame(
            [(i.get("flow_id", "f"), *[i.get(f.name) for f in fields]) for i in items], ddl
        )

    return build


def broken(components, *items):
    return sorted((v.component_id, v.rule, v.value) for v in validate_components(components(*items)).collect())


def test_service_and_remote_rules(components):
    bad = [
        ({**SERVICE, "name": None}, "name_not_empty", None), ({**SERVICE, "class": ""}, "class_not_empty", ""),
        ({**SERVICE, "enabled": None}, "enabled", None), ({**SERVICE, "properties": {"": "x"}}, "property_name_not_empty", None),
        ({**PROCESSOR, "properties": {"": "x"}}, "property_name_not_empty", None), ({**REMOTE, "url": None}, "url_present", None),
        ({**REMOTE, "timeout": None}, "timeout_present", None), ({**REMOTE, "transmitting": "no"}, "transmitting", "no"),
    ]
    rows = [{**item, "id": f"{k}"} for k, (item, _, _) in enumerate(bad)]
    assert broken(components, *rows) == [(f"{k}", rule, value) for k, (_, rule, value) in enumerate(bad)]


def test_good_components_have_no_violations(components):
    assert broken(components, PROCESSOR, CONNECTION, PORT, SERVICE, REMOTE) == []


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"id": ""}, "id_not_empty"),
        ({"name": ""}, "name_not_empty"),
        ({"class": None}, "class_not_empty"),
        ({"scheduled_state": "running"}, "scheduled_state"),
        ({"scheduling_strategy": "CRON"}, "scheduling_strategy"),
        ({"penalization_period": "soon"}, "penalization_period"),
        ({"penalization_period": "30 sec."}, "penalization_period"),
        ({"yield_period": None}, "yield_period"),
        ({"bulletin_level": "LOUD"}, "bulletin_level"),
        ({"execution_node": "SOME"}, "execution_node"),
        ({"max_concurrent_tasks": "-1"}, "max_concurrent_tasks"),
        ({"max_concurrent_tasks": "many"}, "max_concurrent_tasks"),
        ({"loss_tolerant": "TRUE"}, "loss_tolerant"),
    ],
)
def test_processor_rules(components, change, rule):
    bad = {**PROCESSOR, **change}
    column = next(iter(change))
    assert broken(components, bad) == [(bad["id"], rule, bad[column])]


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"name": None}, "name_present"),
        ({"source_type": ""}, "source_type_not_empty"),
        ({"destination_group_id": None}, "destination_group_id_not_empty"),
        ({"max_work_queue_size": "1.5"}, "max_work_queue_size"),
        ({"max_work_queue_data_size": "1 PB"}, "max_work_queue_data_size"),
        ({"flow_file_expiration": "never"}, "flow_file_expiration"),
    ],
)
def test_connection_rules(components, change, rule):
    bad = {**CONNECTION, **change}
    assert broken(components, bad) == [("c", rule, bad[next(iter(change))])]


def test_missing_relationship(components):
    assert broken(components, {**CONNECTION, "relationships": None}) == [("c", "relationship_present", None)]


def test_root_ports_need_a_positive_task_count(components):
    assert broken(components, {**PORT, "max_concurrent_tasks": "0"}) == [("i", "root_port_concurrent_tasks", "0")]
    assert broken(components, {**PORT, "max_concurrent_tasks": None, "group_depth": 2}) == []


def test_optional_values_and_allowed_forms(components):
    fine = {**PROCESSOR, "scheduling_strategy": "CRON_DRIVEN", "execution_node": "PRIMARY", "yield_period": "5   weeks"}
    sized = {**CONNECTION, "max_work_queue_data_size": "10kb", "flow_file_expiration": "0 min"}
    assert broken(components, fine, sized) == []


def test_schema_version(components):
    new = {**CONNECTION, "flow_id": "new", "load_balance_compression": ""}
    found = {r.flow_id: r.schema_version for r in schema_version_diff(components(CONNECTION, PROCESSOR, new)).collect()}
    assert found == {"f": "1.7", "new": "1.8"}
