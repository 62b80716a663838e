"""Declarative document mapping: a small table of rules becomes one column expression.

A definition has named outputs; each output is an object built from rules. ``kind`` is one of

* ``copy``  – the value at ``source_path``, keeping its JSON type; left out when missing
* ``const`` – the text ``const_value``
* ``root``  – the whole document the output was given
* ``nest``  – the object of the output named by ``const_value``, given the value at ``source_path``

``is_array`` puts the value into an array of one. Rules of the output ``""`` make the result. The
definition is checked on the driver before any row is read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions import jsonx
from clinflow.operators.outcomes import checked, error_entry, split_ok

KINDS = ("copy", "const", "root", "nest")
ROOT_OUTPUT = ""
MAPPING_STEP = "MapMessages"

_PATH = re.compile(r"\$(\.[A-Za-z_][\w-]*|\[\d+\]|\['[^']+'\])*")
_TARGET = re.compile(r"[A-Za-z_][\w-]*")


class MappingError(ValueError):
    """The mapping definition cannot be used."""


@dataclass(frozen=True)
class Rule:
    output: str
    target_path: str
    kind: str
    source_path: str | None = None
    const_value: str | None = None
    is_array: bool = False


def copy(output: str, target: str, source: str, is_array: bool = False) -> Rule:
    """J1."""
    return Rule(output, target, "copy", source_path=source, is_array=is_array)


def const(output: str, target: str, value: str, is_array: bool = False) -> Rule:
    """J2."""
    return Rule(output, target, "const", const_value=value, is_array=is_array)


def root(output: str, target: str, is_array: bool = False) -> Rule:
    """J5, and J8 with ``is_array``."""
    return Rule(output, target, "root", is_array=is_array)


def nest(
    output: str, target: str, of: str, source: str = "$", is_array: bool = False
) -> Rule:
    """J3, J4, J6."""
    return Rule(output, target, "nest", source_path=source, const_value=of, is_array=is_array)


class Mapping:
    """A checked definition."""

    def __init__(self, rules: Iterable[Rule], post: str | None = None):
        self.rules = tuple(rules)
        self.post = post
        self._check()

    @classmethod
    def from_text(cls, text: str) -> Mapping:
        """A JSON object with a list of ``rules`` and, if there is one, the ``post`` step."""
        try:
            definition = json.loads(text)
            return cls([Rule(**row) for row in definition["rules"]], definition.get("post"))
        except MappingError:
            raise
        except (ValueError, TypeError, KeyError) as e:
            raise MappingError(f"not a mapping definition: {e}") from e

    @classmethod
    def from_table(cls, df: DataFrame, post: str | None = None) -> Mapping:
        """Rules of a table shaped like ``schemas.MAPPING_RULE``, a definition written by hand."""
        rows = df.coalesce(1).toLocalIterator()  # a job per partition otherwise
        return cls([Rule(**{**r.asDict(), "is_array": bool(r["is_array"])}) for r in rows], post)

    def to_text(self) -> str:
        return json.dumps({"rules": [vars(r) for r in self.rules], "post": self.post})

    def _of(self, output: str) -> list[Rule]:
        return [r for r in self.rules if r.output == output]

    def _check(self) -> None:
        outputs = {r.output for r in self.rules}
        if ROOT_OUTPUT not in outputs:
            raise MappingError("no rule makes the result")
        targets = set()
        for r in self.rules:
            if r.kind not in KINDS:
                raise MappingError(f"unknown kind {r.kind!r}")
            if not _TARGET.fullmatch(r.target_path or ""):
                raise MappingError(f"bad target {r.target_path!r}")
            if (r.output, r.target_path) in targets:
                raise MappingError(f"{r.target_path!r} is set twice")
            targets.add((r.output, r.target_path))
            if r.kind in ("copy", "nest") and not _PATH.fullmatch(r.source_path or ""):
                raise MappingError(f"bad source {r.source_path!r}")
            if r.kind in ("const", "nest") and r.const_value is None:
                raise MappingError(f"{r.target_path!r} has no value")
            if r.kind == "nest" and r.const_value not in outputs - {ROOT_OUTPUT}:
                raise MappingError(f"unknown output {r.const_value!r}")
        if self.post not in (None, "transaction"):
            raise MappingError(f"unknown post step {self.post!r}")
        if self.post and any(r.kind != "nest" or not r.is_array for r in self._of(ROOT_OUTPUT)):
            raise MappingError("a transaction needs lists of resources as its result")
        self._check_cycles(ROOT_OUTPUT, ())

    def _check_cycles(self, output: str, above: tuple[str, ...]) -> None:
        if output in above:
            raise MappingError(f"output {output!r} contains itself")
        for r in self._of(output):
            if r.kind == "nest":
                self._check_cycles(r.const_value, (*above, output))

    def _object(self, output: str, doc: Column, at: str) -> Column:
        fields = [self._value(r, doc, at).alias(r.target_path) for r in self._of(output)]
        return F.struct(*fields)

    def _value(self, rule: Rule, doc: Column, at: str) -> Column:
        """The value of a rule, in a list if it asks for one; null if its source is missing.

        ``at`` is where in the document the output was given its own. Paths are put together, so
        that each value is one look into the document, however deep the outputs are nested.
        """
        made = (lambda v: F.array(v)) if rule.is_array else (lambda v: v)
        if rule.kind == "const":
            return made(F.lit(rule.const_value))
        path = at if rule.kind == "root" else at + rule.source_path[1:]
        source = _look(doc, path)
        if rule.kind == "nest":
            inner = made(self._object(rule.const_value, doc, path))
            return inner if rule.source_path == "$" else F.when(source.isNotNull(), inner)
        if rule.kind == "root" or not rule.is_array:
            return made(source)
        return F.when(source.isNotNull(), made(source))

    def column(self, doc: Column) -> Column:
        """The result object as a struct column."""
        return self._object(ROOT_OUTPUT, doc, "$")

    def text(self, doc: Column) -> Column:
        """The result object as JSON text; missing fields are left out, JSON nulls kept."""
        if self.post == "transaction":
            return bundle_text("transaction", self._entries(doc))
        return F.to_json(self.column(doc))

    def _entries(self, doc: Column) -> list[Column]:
        """Every resource of the result as an entry, PUT under its type and id."""
        entries = []
        for r in self._of(ROOT_OUTPUT):
            named = {
                f.target_path: self._value(f, doc, r.source_path).cast("string")
                for f in self._of(r.const_value)
                if f.target_path in ("resourceType", "id")
            }
            url = F.concat_ws("/", *[named[k] for k in ("resourceType", "id") if k in named])
            resource = F.to_json(self._object(r.const_value, doc, r.source_path))
            entries.append(F.when(_look(doc, r.source_path).isNotNull(), bundle_entry(resource, url)))
        return entries


def _look(doc: Column, path: str) -> Column:
    """The value at a path, with its type; null where there is none."""
    return doc if path == "$" else F.try_variant_get(doc, path, "variant")


def map_stage(
    df: DataFrame,
    mapping: Mapping,
    data: str = "data",
    source_id: str = "id",
    source_time: str | None = None,
    doc: str | None = None,
) -> DataFrame:
    """Add ``output`` — and ``source_time`` — with ``ok`` and ``error``.

    Data that is not JSON yields an error entry whose only source is the row's id. Split the result
    with ``split_ok``. ``doc`` names a column that holds the parsed data already.
    """
    parsed = jsonx.with_document(df, data, "_doc") if doc is None else df
    value = F.col("_doc" if doc is None else doc)
    ok = jsonx.is_json(value)
    entry = error_entry(
        jsonx.not_parsed(F.col(data), value, "the input is not valid JSON"),
        MAPPING_STEP,
        sources=F.array(F.col(source_id).cast("string")),
    )
    out = parsed.withColumn("output", F.when(ok, mapping.text(value)))
    if source_time is not None:
        out = out.withColumn("source_time", F.col(source_time))
    return checked(out, ok, entry).drop("_doc" if doc is None else doc)


def bundle_entry(resource: Column, url: Column | str) -> Column:
    """The text of one PUT entry."""
    target = F.lit(url) if isinstance(url, str) else url
    return F.concat(
        F.lit('{"resource":'),
        resource,
        F.lit(',"request":{"method":"PUT","url":'),
        jsonx.quoted(target),
        F.lit("}}"),
    )


def bundle_text(kind: str, entries: list[Column]) -> Column:
    return F.concat(
        F.lit(f'{{"resourceType":"Bundle","type":"{kind}","entry":['),
        F.concat_ws(",", *entries),
        F.lit("]}"),
    )


def batch_bundle(resource: Column, url: Column | str) -> Column:
    """A checked resource text as a batch bundle with one PUT entry; null members are dropped."""
    text = jsonx.without_nulls(jsonx.compact(resource))
    return bundle_text("batch", [bundle_entry(text, url)])


def bundle_stage(df: DataFrame, resource: str, url: str, step: str = "CreateBundle") -> DataFrame:
    """J10 with its gate: the resource has to be a JSON object."""
    parsed = jsonx.with_document(df, resource, "_doc")
    ok = jsonx.is_object(F.col(resource), F.col("_doc"))
    out = parsed.withColumn("bundle", F.when(ok, batch_bundle(F.col(resource), url)))
    message = jsonx.not_parsed(F.col(resource), F.col("_doc"), "the resource is not a JSON object")
    entry = error_entry(message, step, resource=F.col(resource))
    return checked(out, F.col("bundle").isNotNull(), entry).drop("_doc")


def checked_entries(
    df: DataFrame, bundle: str, keep: list[str], step: str = "ReadBundle"
) -> DataFrame:
    """The inverse of J7 and J10: a row per entry of a bundle text, with ``ok`` and ``error``.

    A text that is no JSON, or has no list of entries, is one rejected row whose ``body`` is the
    text. A bundle with an empty list has no rows.
    """
    parsed = jsonx.with_document(df.select(*keep, bundle), bundle, "_doc")
    entries = F.try_variant_get("_doc", "$.entry", "array<variant>")
    listed = parsed.withColumn("_entries", jsonx.once(entries))
    message = F.when(
        F.col("_doc").isNull(),
        jsonx.not_parsed(F.col(bundle), F.col("_doc"), "the bundle is not valid JSON"),
    ).otherwise(F.lit("the bundle has no list of entries"))
    one = listed.select(
        *keep,
        F.when(F.col("_entries").isNull(), F.coalesce(bundle, F.lit(""))).alias("_text"),
        F.when(F.col("_entries").isNull(), message).alias("_message"),
        F.posexplode_outer("_entries").alias("position", "_entry"),
    ).filter(F.col("_message").isNotNull() | F.col("position").isNotNull())
    resource = F.try_variant_get("_entry", "$.resource", "variant")
    rows = one.select(
        *keep,
        "position",
        F.try_variant_get("_entry", "$.request.method", "string").alias("method"),
        F.try_variant_get("_entry", "$.request.url", "string").alias("url"),
        F.try_variant_get(resource, "$.resourceType", "string").alias("resource_type"),
        F.try_variant_get(resource, "$.id", "string").alias("id"),
        F.coalesce("_text", F.to_json(resource)).alias("body"),
        "_message",
    )
    entry = error_entry(F.col("_message"), step, resource=F.col("body"))
    return checked(rows, F.col("_message").isNull(), entry).drop("_message")


def bundle_entries(df: DataFrame, bundle: str, keep: list[str]) -> DataFrame:
    """The entries of the bundles that can be read."""
    return split_ok(checked_entries(df, bundle, keep))[0]


def mappable(messages: DataFrame, create_time: bool = True) -> DataFrame:
    """A stored message as input of ``map_stage``: its name, its parsed form, its create time."""
    time = [F.col("create_time")] if create_time else []
    return messages.select(F.col("name").alias("id"), F.col("schematized_data").alias("data"), *time)
