"""The corpus-wide inventory of element paths (inventory A1, A2, A17, K2, R8, U6).

Each document is walked once by expat into one row per distinct path; paths and their
counts are summed with map-side aggregation, so what is shuffled is the set of paths.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def walk(xml: str) -> dict[str, tuple[int, set[str]]]:
    """Path -> (elements, attribute names); nothing for a text that is not well formed."""
    found: dict[str, tuple[int, set[str]]] = {}
    stack = [""]

    def start(name, attrs):
        stack.append(f"{stack[-1]}/{name}")
        n, names = found.get(stack[-1], (0, set()))
        names.update(attrs)
        found[stack[-1]] = (n + 1, names)

    p = expat.ParserCreate()
    p.StartElementHandler = start
    p.EndElementHandler = lambda _: stack.pop()
    try:
        p.Parse(xml.encode(), True)
    except expat.ExpatError:
        return {}
    return found


def paths(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """xpath, countElement and attributes per document and path."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            total: dict[str, list] = {}
            for text in batch.column(0).to_pylist():
                for path, (n, names) in walk(text or "").items():
                    one = total.setdefault(path, [0, set()])
                    one[0] += n
                    one[1] |= names
            if total:
                yield pa.record_batch({"xpath": list(total), "countElement": pa.array([x[0] for x in total.values()], pa.int64()), "attributes": pa.array([sorted(x[1]) for x in total.values()], pa.list_(pa.string()))})

    return docs.select(xml).mapInArrow(run, "xpath string, countElement long, attributes array<string>")


def summed(rows: DataFrame) -> DataFrame:
    """xpath, countElement, attributes (sorted distinct names) of all rows of ``paths``."""
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_set("attributes"))))
    return rows.groupBy("xpath").agg(F.sum("countElement").alias("countElement"), names.alias("attributes"))


def inventory(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """xpath, countElement, attributes (sorted distinct names) over all documents."""
    return summed(paths(docs, xml))


def write_csv(found: DataFrame, path: str) -> None:
    """``xpath;count;attribute,attribute`` lines without a header."""
    found.select("xpath", "countElement", F.array_join("attributes", ",").alias("attributes")).write.mode("overwrite").option("sep", ";").option("quote", "").option("emptyValue", "").csv(path)
