"""Groups within groups of XML documents, however deep."""
from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reader(kind: T.DataType) -> Callable[[ElementTree.Element], Any]:
    """What makes an element a value of a type: attributes are fields that begin with _, an array takes all children of its
    name, another field the first. The type is read once and each child looked at once; fields without a value are left out."""
    if not isinstance(kind, T.StructType):
        return lambda e: (e.text or "").strip()
    attributes = [(f.name, f.name[1:]) for f in kind.fields if f.name.startswith("_")]
    below = {f.name: f.dataType for f in kind.fields if not f.name.startswith("_")}
    several = [c for c, x in below.items() if isinstance(x, T.ArrayType)]
    readers = {c: reader(x.elementType if c in several else x) for c, x in below.items()}

    def read(e: ElementTree.Element) -> dict:
        out: dict[str, Any] = {c: [] for c in several}
        for c, name in attributes:
            if (value := e.get(name)) is not None:
                out[c] = value
        for x in e:
            if x.tag in readers:
                if x.tag in several:
                    out[x.tag].append(readers[x.tag](x))
                elif x.tag not in out:
                    out[x.tag] = readers[x.tag](x)
        return out

    return read


def groups(text: str, path: Sequence[str], keys: Sequence[str], read: Callable[[ElementTree.Element], dict], separator: str) -> Iterator[tuple]:
    """(keys..., lineage, depth, fields as JSON) of all groups below path, parents before children, by a stack of its own
    and not by recursion; none of a text that isn't XML."""
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError:
        return
    own = [(root.findtext(k) or "").strip() for k in keys]
    stack = [(e, "", 1) for top in root.findall("/".join(path[:-1])) for e in reversed(top.findall(path[-1]))]
    while stack:
        e, above, depth = stack.pop()
        lineage = above + (separator if depth > 1 else "") + e.get("name", "")
        fields = read(e)
        yield *own, lineage, depth, json.dumps(fields) if fields else "{}"
        stack += [(x, lineage, depth + 1) for x in reversed(e.findall(path[-1]))]


def groups_at_any_depth(raw: DataFrame, path: str, fields: str, keys: Sequence[str], *, separator: str = " || ") -> DataFrame:
    """source_file, keys, lineage (names from the outermost group inwards), depth and the fields (DDL) of each group in the
    groups at path (element names with dots, of which the last one is the groups' own) of raw(value: a document's text,
    source_file). A document that isn't XML has no groups here: it is among the failures of its own parse, and the others'
    groups are all there, however deep. One document is held by a task at a time."""
    kind, names = T.StructType.fromDDL(fields), list(keys)
    columns = ["source_file", *names, "lineage", "depth", "found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(kind)
        for b in batches:
            each = zip(b.column("source_file").to_pylist(), b.column("value"))
            found = ((source, *g) for source, text in each for g in groups(text.as_py() or "", path.split("."), names, read, separator))
            while rows := list(islice(found, 5000)):
                yield pa.record_batch([pa.array(x, pa.int32() if c == "depth" else pa.string()) for c, x in zip(columns, zip(*rows))], columns)

    schema = ", ".join(f"{c} {'int' if c == 'depth' else 'string'}" for c in columns)
    found = raw.select("source_file", "value").mapInArrow(run, schema)
    return found.withColumn("found", F.from_json("found", kind)).select(*columns[:-1], "found.*")
