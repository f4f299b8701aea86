"""Flow configuration files (gzip XML, recursive groups) as flat component rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Component ids within a flow follow document order, in one block per kind so
# that groups sort before processors and those before connections.
SEQ_BLOCK = 10**12

_TEXT = [
    "kind", "id", "parent_group_id", "name", "class", "scheduled_state", "scheduling_strategy",
    "scheduling_period", "penalization_period", "yield_period", "bulletin_level", "execution_node",
    "max_concurrent_tasks", "source_id", "source_group_id", "source_type", "destination_id",
    "destination_group_id", "destination_type", "max_work_queue_size", "max_work_queue_data_size",
    "flow_file_expiration", "load_balance_strategy", "partitioning_attribute",
    "load_balance_compression", "encoding_version", "loss_tolerant", "url", "timeout", "transmitting", "enabled",
]

PARSED_SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("reject_reason", T.StringType())]
    + [T.StructField("seq", T.LongType()), T.StructField("group_depth", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in _TEXT]
    + [
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("relationships", T.ArrayType(T.StringType())),
    ]
)

# Component elements of the format, and the child elements read
# from each of them.
_KINDS = (
    "processGroup", "processor", "inputPort", "outputPort", "connection", "remoteProcessGroup",
    "controllerService", "funnel", "label",
)
_FIELDS = {
    "class": "class", "scheduledState": "scheduled_state", "schedulingStrategy": "scheduling_strategy",
    "schedulingPeriod": "scheduling_period", "penalizationPeriod": "penalization_period",
    "yieldPeriod": "yield_period", "bulletinLevel": "bulletin_level", "executionNode": "execution_node",
    "maxConcurrentTasks": "max_concurrent_tasks", "id": "id", "name": "name",
    "sourceId": "source_id", "sourceGroupId": "source_group_id", "sourceType": "source_type",
    "destinationId": "destination_id", "destinationGroupId": "destination_group_id",
    "destinationType": "destination_type", "maxWorkQueueSize": "max_work_queue_size",
    "maxWorkQueueDataSize": "max_work_queue_data_size", "flowFileExpiration": "flow_file_expiration",
    "loadBalanceStrategy": "load_balance_strategy", "partitioningAttribute": "partitioning_attribute",
    "loadBalanceCompression": "load_balance_compression", "lossTolerant": "loss_tolerant", "url": "url",
    "timeout": "timeout", "transmitting": "transmitting", "enabled": "enabled",
}


def _parse_batches(batch_rows: int = 10_000, whole_bytes: int = 1 << 20):
    """The function for ``mapInArrow``.

    A document of up to ``whole_bytes`` is read into a tree in one call, several
    times as fast as with a call per element. A longer one is read piece by
    piece, unpacked as it is read, and an element is forgotten when it ends, so
    that memory follows the depth of the groups and the size of a batch; so is
    one that the tree cannot hold, which gives the reason. A document with more
    components than a batch is then read through once before its first row
    leaves, as one that breaks off halfway must give none. Everything the
    function needs is local to it, so executors do not have to have this package
    installed.
    """
    kinds, fields = frozenset(_KINDS), dict(_FIELDS)
    blocks = {"processGroup": SEQ_BLOCK, "processor": 2 * SEQ_BLOCK, "connection": 3 * SEQ_BLOCK}
    other_block = 4 * SEQ_BLOCK
    texts = list(_TEXT)

    def parse(batches):
        import gzip
        import io
        import zlib
        from xml.etree import ElementTree
        from xml.parsers import expat

        import pyarrow as pa

        schema = pa.schema(
            [("path", pa.string()), ("reject_reason", pa.string()), ("seq", pa.int64()), ("group_depth", pa.int32())]
            + [(c, pa.string()) for c in texts]
            + [("properties", pa.map_(pa.string(), pa.string())), ("relationships", pa.list_(pa.string()))]
        )

        local_names = {}

        def local(tag):
            """The name without its namespace; a few hundred different ones are remembered."""
            name = local_names.get(tag)
            if name is None:
                name = tag[tag.rfind("}") + 1 :]
                if len(local_names) < 1000:
                    local_names[tag] = name
            return name

        def unpacked(content):
            """The document if it is a short one of a single member, else None."""
            if content[:2] == b"\x1f\x8b":
                member = zlib.decompressobj(31)
                content = member.decompress(content, whole_bytes + 1)
                if not member.eof or member.unused_data:
                    return None
            # Declared entities and wider characters are left to the other way.
            return content if len(content) <= whole_bytes and b"<!DOCTYPE" not in content and b"\0" not in content else None

        def leaf(row, element):
            """The fields of a component that holds no others, properties apart."""
            pairs = {}
            for child in element:
                tag = local(child.tag)
                if tag in fields:
                    if fields[tag] not in row:
                        row[fields[tag]] = child.text or ""
                elif tag == "property":
                    pair = {local(c.tag): c.text or "" for c in child}
                    pairs[pair.get("name", "")] = pair.get("value")
                elif tag == "relationship":
                    row.setdefault("relationships", []).append(child.text or "")
            if row["kind"] in ("processor", "controllerService"):
                row["properties"] = list(pairs.items())

        def rows_of_tree(path, content):
            """The rows of a short document without a fault, else None."""
            try:
                content = unpacked(content) if content and whole_bytes else None
                tree = ElementTree.fromstring(content) if content else None
            except (ElementTree.ParseError, LookupError, ValueError, zlib.error):
                tree = None
            root = None if tree is None else next((e for e in tree.iter() if local(e.tag) == "rootGroup"), None)
            if root is None:
                return None
            rows, counts = [], dict.fromkeys([*blocks.values(), other_block], 0)
            top = {"kind": "rootGroup"}
            # Groups that have not ended: row, children to come, rows of its members.
            nested = [(top, iter(root), [])]
            while nested:
                group, children, members = nested[-1]
                for element in children:
                    tag = local(element.tag)
                    if tag in kinds:
                        block = blocks.get(tag, other_block)
                        counts[block] += 1
                        row = {"path": path, "kind": tag, "seq": block + counts[block], "group_depth": len(nested) - 1}
                        members.append(row)
                        if tag == "processGroup":
                            nested.append((row, iter(element), []))
                            break
                        leaf(row, element)
                    elif tag in fields:
                        if fields[tag] not in group:
                            group[fields[tag]] = element.text or ""
                    elif tag == "relationship":
                        group.setdefault("relationships", []).append(element.text or "")
                else:
                    nested.pop()
                    for row in members:
                        row["parent_group_id"] = group.get("id")
                    rows += members
            if "id" not in top or "name" not in top:
                return None
            rows.append(
                {"path": path, "kind": "rootGroup", "seq": 0, "group_depth": 0, "id": top["id"], "name": top["name"],
                 "encoding_version": root.get("encoding-version")}
            )
            return rows

        class Rejected(Exception):
            pass

        class Open:
            """A component whose element has not ended; ``number`` counts the groups."""

            __slots__ = ("row", "depth", "inside", "group_depth", "number", "early", "properties")

            def __init__(self, row, depth, inside, group_depth=None, number=None):
                self.row, self.depth, self.inside, self.group_depth, self.number = row, depth, inside, group_depth, number
                self.early, self.properties = False, {}

        class Scan:
            """Finished components of one document as (row, group that holds it), while its text comes in.

            Components are numbered as they begin and done as they end.
            ``late_ids`` gets the ids of groups that stand behind a member.
            """

            def __init__(self):
                self.done, self.late_ids, self.open, self.counts = [], {}, [], {}
                self.depth, self.n_groups, self.root = 0, 0, None
                self.field = self.pair = self.pair_depth = None
                self.text, self.listening = [], False
                self.parser = expat.ParserCreate(namespace_separator="}")
                self.parser.buffer_text = True
                self.parser.StartElementHandler, self.parser.EndElementHandler = self.start, self.end
                self.parser.CharacterDataHandler, self.parser.SkippedEntityHandler = self.characters, self.skipped

            def characters(self, text):
                if self.listening:
                    self.text.append(text)

            def skipped(self, name, is_parameter):
                raise Rejected("unreadable: ParseError")

            def listen(self, tag):
                self.field, self.text, self.listening = (tag, self.depth), [], True

            def start(self, name, attributes):
                tag = name[name.rfind("}") + 1 :]
                self.depth += 1
                self.listening = False  # a field's text is what stands before its first child
                if not self.open:
                    if self.root is None and tag == "rootGroup":
                        row = {"kind": tag, "seq": 0, "group_depth": 0, "encoding_version": attributes.get("encoding-version")}
                        self.root = Open(row, self.depth, None, 0, 0)
                        self.open.append(self.root)
                    return
                inside = self.open[-1]
                if self.depth == inside.depth + 1:
                    if inside.number is not None and tag in kinds:
                        self.begin(tag, inside)
                    elif tag == "property":
                        self.pair, self.pair_depth = {}, self.depth
                    elif tag in fields or tag == "relationship":
                        self.listen(tag)
                elif self.pair is not None and self.depth == self.pair_depth + 1:
                    self.listen(tag)

            def begin(self, kind, inside):
                inside.early |= "id" not in inside.row
                block = blocks.get(kind, other_block)
                self.counts[block] = self.counts.get(block, 0) + 1
                row = {"kind": kind, "seq": block + self.counts[block], "group_depth": inside.group_depth}
                if kind == "processGroup":
                    self.n_groups += 1
                    self.open.append(Open(row, self.depth, inside, inside.group_depth + 1, self.n_groups))
                else:
                    self.open.append(Open(row, self.depth, inside))

            def end(self, name):
                if self.field is not None and self.depth == self.field[1]:
                    self.store(self.field[0], "".join(self.text))
                    self.field, self.listening = None, False
                elif self.pair is not None and self.depth == self.pair_depth:
                    self.open[-1].properties[self.pair.get("name", "")] = self.pair.get("value")
                    self.pair = None
                elif self.open and self.depth == self.open[-1].depth:
                    self.finish(self.open.pop())
                self.depth -= 1

            def store(self, tag, text):
                row = self.open[-1].row
                if self.pair is not None:
                    self.pair[tag] = text
                elif tag == "relationship":
                    row.setdefault("relationships", []).append(text)
                else:
                    row.setdefault(fields[tag], text)

            def finish(self, component):
                row = component.row
                if component is self.root:
                    for needed in ("id", "name"):
                        if needed not in row:
                            raise Rejected(f"rootGroup without {needed}")
                    row = {c: row[c] for c in ("kind", "seq", "group_depth", "encoding_version", "id", "name")}
                elif row["kind"] in ("processor", "controllerService"):
                    row["properties"] = list(component.properties.items())
                if component.early:
                    self.late_ids[component.number] = row.get("id")
                self.done.append((row, component.inside))

            def pieces(self, content, size=1 << 16):
                """Hands over what is done after every piece of the document."""
                if not content:
                    raise Rejected("empty file")
                packed = content[:2] == b"\x1f\x8b"
                with gzip.open(io.BytesIO(content)) if packed else io.BytesIO(content) as stream:
                    nothing = True
                    while piece := stream.read(size):
                        nothing = False
                        self.parser.Parse(piece, False)
                        done, self.done = self.done, []
                        yield done
                if nothing:
                    raise Rejected("empty file")
                self.parser.Parse(b"", True)
                if self.root is None:
                    raise Rejected("no rootGroup")
                yield self.done

        def rows_of(path, content):
            """Batches of finished rows of a document, or one row that says why there are none."""
            scan, late_ids = Scan(), None
            held = []

            def released():
                known = scan.late_ids if late_ids is None else late_ids
                for row, inside in held:
                    row["path"] = path
                    if inside is not None:
                        row["parent_group_id"] = inside.row["id"] if "id" in inside.row else known.get(inside.number)
                    yield row

            try:
                for done in scan.pieces(content):
                    held += done
                    if len(held) >= batch_rows:
                        if late_ids is None:
                            whole = Scan()
                            for _ in whole.pieces(content):
                                pass
                            late_ids = whole.late_ids
                        yield list(released())
                        held = []
                yield list(released())
            except Rejected as why:
                yield [{"path": path, "reject_reason": str(why)}]
            except expat.ExpatError:
                yield [{"path": path, "reject_reason": "unreadable: ParseError"}]
            except (EOFError, OSError, LookupError, ValueError, zlib.error) as error:
                yield [{"path": path, "reject_reason": f"unreadable: {type(error).__name__}"}]

        row_type = pa.struct(schema)

        def as_batch(rows):
            return pa.RecordBatch.from_struct_array(pa.array(rows, row_type))

        pending = []
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path, content = path.as_py(), content.as_py()
                whole = rows_of_tree(path, content)
                for rows in rows_of(path, content) if whole is None else [whole]:
                    pending += rows
                    for at in range(0, len(pending) - batch_rows + 1, batch_rows):
                        yield as_batch(pending[at : at + batch_rows])
                    del pending[: len(pending) // batch_rows * batch_rows]
        if pending:
            yield as_batch(pending)

    return parse


def parse_flow_documents(documents: DataFrame, flow_id: Column | None = None) -> DataFrame:
    """Parses (path, content) rows, content gzipped or plain, into component and reject rows.

    One document is one row, as one file is one unit of the format. Use
    :func:`components` and :func:`rejects` on the result, materialised first if
    both are wanted.
    """
    parsed = documents.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(
        _parse_batches(), PARSED_SCHEMA
    )
    return parsed.select((F.col("path") if flow_id is None else flow_id).alias("flow_id"), "*")


def read_flow_configs(spark: SparkSession, path: str, flow_id: Column | None = None) -> DataFrame:
    """Parses all files below ``path``; files without a single byte are skipped by the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return parse_flow_documents(files.select("path", "content"), flow_id)


def components(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "path")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("path", F.col("reject_reason").alias("reason"))


def flatten_groups(components: DataFrame) -> DataFrame:
    """All groups, nested ones included, with the id of the group they lie in."""
    return components.filter(F.col("kind").isin("rootGroup", "processGroup")).select(
        "flow_id", "seq", "kind", "id", "name", "parent_group_id", "group_depth"
    )


def is_processor(include_root: bool = False) -> Column:
    """Processors of nested groups; those directly under the root only on request."""
    processor = F.col("kind") == "processor"
    return processor if include_root else processor & (F.col("group_depth") > 0)


def processors(components: DataFrame, include_root_processors: bool = False) -> DataFrame:
    return components.filter(is_processor(include_root_processors))


def cross_group_connections(components: DataFrame) -> DataFrame:
    """Connections between two different groups, ids compared ignoring case."""
    return components.filter(
        (F.col("kind") == "connection")
        & (F.lower("source_group_id") != F.lower("destination_group_id"))
    )


def root_ports(components: DataFrame) -> DataFrame:
    return components.filter(
        F.col("kind").isin("inputPort", "outputPort") & (F.col("group_depth") == 0)
    ).select("flow_id", "seq", "id", "name", F.col("kind").alias("type"), "scheduled_state", "max_concurrent_tasks")
