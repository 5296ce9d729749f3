"""Where results go: JSON lines, path reports, enrichment files, models, run logs (inventory K1-K8)."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_json(docs: DataFrame, folder: str, corpusname: str, level: str = "info", now: str | None = None) -> str:
    """One JSON line per record with level, message and timestamp; returns the path."""
    path = f"{folder}/analyse-{corpusname}.json"
    stamp = F.lit(now) if now else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    docs.withColumns({"level": F.lit(level), "message": F.lit(""), "timestamp": stamp}).write.mode("overwrite").json(path)
    return path


# ---------------------------------------------------------------- templates
def compile_template(template: str) -> Callable[[dict], str]:
    """The subset of logic-less templates in use: {{x.y}}, {{{x}}}, {{#list}}..{{/list}}, {{^x}}..{{/x}}, {{.}}."""
    parts = re.split(r"\{\{\{\s*([^}]+?)\s*\}\}\}|\{\{\s*([#/^]?)\s*([^}]+?)\s*\}\}", template)
    root: list = []
    stack = [("", root)]
    for i in range(0, len(parts), 4):
        if parts[i]:
            stack[-1][1].append(("text", parts[i]))
        if i + 3 >= len(parts):
            break
        raw, kind, name = parts[i + 1 : i + 4]
        if raw is not None:
            stack[-1][1].append(("raw", raw))
        elif kind in ("#", "^"):
            inner: list = []
            stack[-1][1].append(("each" if kind == "#" else "none", name, inner))
            stack.append((name, inner))
        elif kind == "/":
            if stack.pop()[0] != name:
                raise ValueError(f"section {name} is not open")
        else:
            stack[-1][1].append(("value", name))
    if len(stack) > 1:
        raise ValueError(f"section {stack[-1][0]} is not closed")

    def look(scopes: list, name: str):
        if name == ".":
            return scopes[-1]
        first, *rest = name.split(".")
        value = next((s[first] for s in reversed(scopes) if isinstance(s, dict) and first in s), None)
        for k in rest:
            value = value.get(k) if isinstance(value, dict) else None
        return value

    def show(v) -> str:
        return "" if v is None else str(v).lower() if isinstance(v, bool) else str(v)

    def render(nodes: list, scopes: list) -> str:
        out = []
        for n in nodes:
            if n[0] == "text":
                out.append(n[1])
            elif n[0] == "raw":
                out.append(show(look(scopes, n[1])))
            elif n[0] == "value":
                out.append(html.escape(show(look(scopes, n[1]))))
            else:
                v = look(scopes, n[1])
                if n[0] == "none":
                    out.append(render(n[2], scopes) if not v else "")
                elif isinstance(v, list):
                    out += [render(n[2], [*scopes, x]) for x in v]
                elif v not in (None, False, ""):
                    out.append(render(n[2], [*scopes, v]))
        return "".join(out)

    return lambda data: render(root, [data])


def template_error(template: str) -> str | None:
    """What is wrong with a template; null if it can be rendered."""
    try:
        compile_template(template)
    except ValueError as e:
        return json.dumps({"message": str(e)})
    return None


def render(template: str, data: Column) -> Column:
    """A struct column through a template."""

    @F.pandas_udf(T.StringType())
    def run(rows: pd.Series) -> pd.Series:
        one = compile_template(template)
        return rows.map(lambda j: None if j is None else one(json.loads(j)))

    return run(F.to_json(data))


def write_enrichments(rendered: DataFrame, folder: str, rows: int = 100_000) -> None:
    """JSON lines (path, label, kind, rendered) in files of at most ``rows`` documents, not a file or folder for each."""
    rendered.write.mode("overwrite").option("maxRecordsPerFile", rows).json(folder)


def append_enrichment(enrichments: Column, label: str, kind: str, output: Column) -> Column:
    """The document's list with one more {label, enrichment {kind, output}}."""
    one = F.struct(F.lit(label).alias("label"), F.struct(F.lit(kind).alias("kind"), output.alias("output")).alias("enrichment"))
    return F.concat(F.coalesce(enrichments, F.array()), F.array(one))


def save_model(model: DataFrame, path: str) -> None:
    """A Bayes model (training, pool, word, p) as a table that sessions read with ``-m`` or as a resource."""
    model.write.mode("overwrite").parquet(path)


def write_guesses(guesses: DataFrame, path: str) -> None:
    """``label;code;probability`` lines."""
    guesses.select("label", "code", "probability").write.mode("overwrite").option("sep", ";").csv(path)


def run_log(errors: DataFrame, path: str) -> None:
    """The records with an error; a bundle that is done again replaces its own."""
    errors.write.mode("overwrite").parquet(path)


def stop_words(words: DataFrame, resources) -> DataFrame:
    """The distinct lemmas of a word list (a column ``value``, a word a row) by lexicon and lemmas, as a stop-word table."""
    from ..operators import keyterms

    tokens = words.select(F.lower(F.trim("value")).alias("token")).where("token != ''").distinct()
    return keyterms.lemmatize(keyterms.tag(tokens, resources.lexicon), resources.lemmas).select("lemma").distinct()
