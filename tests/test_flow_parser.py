"""The streaming parser of flow documents against a walk over the whole tree, and its memory."""

import gzip
import random
import subprocess
import sys
import xml.etree.ElementTree as ET

import pyarrow as pa
import pytest

from flowline.sources import flow_xml as fx

BLOCKS = {"processGroup": 1, "processor": 2, "connection": 3}


def plain_rows(document):
    """Components by a walk over the tree of the document; or why there are none."""
    local = lambda el: el.tag.rpartition("}")[2]
    root = next((el for el in ET.fromstring(document).iter() if local(el) == "rootGroup"), None)
    if root is None:
        return "no rootGroup"
    first = lambda el, tag: next((c.text or "" for c in el if local(c) == tag), None)
    for needed in ("id", "name"):
        if first(root, needed) is None:
            return f"rootGroup without {needed}"
    encoding = root.get("encoding-version")
    rows, counts = [{"kind": "rootGroup", "seq": 0, "group_depth": 0, "id": first(root, "id"), "name": first(root, "name")}], {}
    rows[0] |= {"encoding_version": encoding} if encoding else {}

    def walk(group, depth):
        for el in group:
            kind = local(el)
            if kind not in fx._KINDS:
                continue
            block = BLOCKS.get(kind, 4) * fx.SEQ_BLOCK
            counts[block] = counts.get(block, 0) + 1
            row = {"kind": kind, "seq": block + counts[block], "group_depth": depth}
            parent = first(group, "id")
            row |= {"parent_group_id": parent} if parent is not None else {}
            row |= {fx._FIELDS[t]: first(el, t) for t in fx._FIELDS if first(el, t) is not None}
            related = [c.text or "" for c in el if local(c) == "relationship"]
            row |= {"relationships": related} if related else {}
            if kind in ("processor", "controllerService"):
                pairs = [{local(c): c.text or "" for c in p} for p in el if local(p) == "property"]
                row["properties"] = dict((p.get("name", ""), p.get("value")) for p in pairs)
            rows.append(row)
            if kind == "processGroup":
                walk(el, depth + 1)

    walk(root, 0)
    return rows


def parsed(documents, batch_rows):
    batch = pa.RecordBatch.from_pydict({"path": [p for p, _ in documents], "content": [c for _, c in documents]})
    found = {p: [] for p, _ in documents}
    for out in fx._parse_batches(batch_rows)([batch]):
        assert out.num_rows <= batch_rows
        for row in out.to_pylist():
            row = {k: v for k, v in row.items() if v is not None}
            if "properties" in row:
                row["properties"] = dict(row["properties"])
            found[row.pop("path")].append(row)
    return found


def element(draw, depth):
    """A random element; ids may stand behind members, fields may be empty, repeated or have children."""
    some = ["id", "name", "class", "url", "relationship", "enabled", "other"]

    def field():
        inner = draw.choice(["", "x", " a &amp; b ", "<![CDATA[<c>]]>", "p<b>q</b>r", "p<!-- no -->q", "é\n", "<property><name>n</name></property>"])
        tag = draw.choice(some)
        return f"<{tag}>{inner}</{tag}>"

    def prop():
        parts = [f"<name>{draw.choice('abc')}</name>", f"<value>{draw.choice(['1', '', 'v<i>w</i>'])}</value>", "<more>z</more>"]
        draw.shuffle(parts)
        return "<property>" + "".join(parts[: draw.randrange(4)]) + "</property>"

    members = [field() for _ in range(draw.randrange(6))] + [prop() for _ in range(draw.randrange(3))]
    kind = draw.choice(fx._KINDS + ("unknown", "rootGroup"))
    if depth:
        members += [element(draw, depth - 1) for _ in range(draw.randrange(4))]
    draw.shuffle(members)
    return f"<{kind}>{''.join(members)}</{kind}>"


def document(draw):
    members = [element(draw, 4) for _ in range(draw.randrange(6))]
    members += draw.choice([["<id>r</id>", "<name>n</name>"]] * 6 + [["<id>r</id>"], ["<name>n</name>"], ["<id/>", "<name/>", "<id>s</id>"]])
    draw.shuffle(members)
    name = draw.choice(['rootGroup encoding-version="1.2"', "rootGroup", "rootGroup xmlns='urn:x'", "f:rootGroup xmlns:f='urn:y'"])
    inner = f"<{name}>{''.join(members)}</{name.split()[0]}>"
    return f"<flow><before/>{inner}<after><processor/></after></flow>".encode()


@pytest.mark.parametrize("batch_rows", [1, 3, 10_000])
def test_pull_parser_equals_a_walk_over_the_tree(batch_rows):
    draw = random.Random(batch_rows)
    documents = [(str(i), document(draw)) for i in range(300)]
    documents = [(p, gzip.compress(c) if draw.random() < 0.5 else c) for p, c in documents]
    found = parsed(documents, batch_rows)
    sort = lambda rows: sorted(rows, key=lambda r: r.get("seq", -1))
    for path, content in documents:
        want = plain_rows(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)
        want = [{"reject_reason": want}] if isinstance(want, str) else want
        assert sort(found[path]) == sort(want), content


@pytest.mark.parametrize("batch_rows", [2, 10_000])
def test_a_document_that_breaks_off_gives_no_rows(batch_rows):
    many = b"<flow><rootGroup><id>r</id><name>n</name>" + b"<processor><id>p</id></processor>" * 5000
    documents = [
        ("cut", many + b"</rootGroup></fl"), ("long", many), ("gz", gzip.compress(many + b"</rootGroup></flow>")[:-20]),
        ("entity", b"<flow><rootGroup><id>&what;</id></rootGroup></flow>"), ("none", b""), ("gz none", gzip.compress(b"")),
        ("twice", many + b"</rootGroup></flow><more/>"), ("good", many + b"</rootGroup></flow>"),
        ("two members", gzip.compress(many) + gzip.compress(b"</rootGroup></flow>")), ("null", None),
    ]
    found = parsed(documents, batch_rows)
    reasons = {p: rows[0].get("reject_reason") for p, rows in found.items()}
    assert reasons == {
        "cut": "unreadable: ParseError", "long": "unreadable: ParseError", "gz": "unreadable: EOFError",
        "entity": "unreadable: ParseError", "none": "empty file", "gz none": "empty file", "twice": "unreadable: ParseError",
        "good": None, "two members": None, "null": "empty file",
    }
    assert {p: len(rows) for p, rows in found.items()} == {p: 5001 if r is None else 1 for p, r in reasons.items()}


LARGE = """
import io, resource, sys, zlib
sys.path.insert(0, {root!r})
import pyarrow as pa
from flowline.sources import flow_xml as fx

n = {n}
packer = zlib.compressobj(1, wbits=31)
one = b"<processor><id>%d</id><name>some processor</name><class>a.b.C</class><property><name>k</name><value>v</value></property></processor>"
pieces = [packer.compress(b"<flow><rootGroup><id>r</id><name>n</name><processGroup>")]
for i in range(n):
    pieces.append(packer.compress(one % i))
pieces.append(packer.compress(b"<id>late</id></processGroup></rootGroup></flow>") + packer.flush())
content = b"".join(pieces)
batch = pa.RecordBatch.from_pydict({{"path": ["p"], "content": [content]}})
parse = fx._parse_batches()
small = pa.RecordBatch.from_pydict({{"path": ["p"], "content": [b"<rootGroup/>"]}})
list(parse([small]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows, late = 0, 0
for out in parse([batch]):
    rows += out.num_rows
    late += sum(x == "late" for x in out.column("parent_group_id").to_pylist())
print(rows, late, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_memory_does_not_follow_the_size_of_a_document():
    root = fx.__file__.rsplit("/flowline/", 1)[0]
    grown = {}
    for n in (50_000, 150_000):
        out = subprocess.run([sys.executable, "-c", LARGE.format(root=root, n=n)], capture_output=True, text=True, check=True)
        rows, late, grown[n] = map(int, out.stdout.split())
        assert rows == n + 2 and late == n
    assert grown[150_000] < 100 and grown[150_000] < grown[50_000] + 30


def test_deep_groups():
    deep = b"<rootGroup><id>r</id><name>n</name>" + b"<processGroup><id>g</id>" * 3000 + b"</processGroup>" * 3000 + b"</rootGroup>"
    rows = parsed([("p", deep)], 10_000)["p"]
    assert len(rows) == 3001 and max(r["group_depth"] for r in rows) == 2999
