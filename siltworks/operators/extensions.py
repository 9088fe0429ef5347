"""Declarative extension labels: specs, routing, validation, statistics and rarity."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.config import LABEL_CONFIDENCE_DEFAULT
from siltworks.operators.labels import trigger
from siltworks.operators.rarity import absolute, idf


@dataclass(frozen=True)
class Spec:
    """An extension: fields with their options (``multi``: the fields that take several), and when it applies."""

    name: str
    version: str
    fields: Mapping[str, tuple[str, ...]]
    multi: tuple[str, ...] = ()
    any_of: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    all_of: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def digest(self) -> str:
        """A hash of the canonical spec: labels of another version aren't mixed with it."""
        body = {"id": self.name, "version": self.version, "fields": {k: list(v) for k, v in sorted(self.fields.items())}, "multi": sorted(self.multi), "any": {k: sorted(v) for k, v in self.any_of.items()}, "all": {k: sorted(v) for k, v in self.all_of.items()}}
        return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def load_specs(paths: list[str]) -> list[Spec]:
    """Specs from JSON or YAML files; two of one name are an error."""
    out: dict[str, Spec] = {}
    for p in paths:
        with open(p, encoding="utf-8") as f:
            text = f.read()
        try:
            d = json.loads(text)
        except ValueError:
            import yaml

            d = yaml.safe_load(text)
        trig, fields = d.get("trigger") or {}, d.get("schema") or {}
        pick = lambda end: {k.removesuffix(end): tuple(v) for k, v in trig.items() if k.endswith(end)}  # noqa: E731, B023
        s = Spec(d["id"], str(d.get("spec_version", "")), {k: tuple(v["options"]) for k, v in fields.items()}, tuple(k for k, v in fields.items() if v.get("type") == "multi_enum"), pick("_any_of"), pick("_all_of"))
        if s.name in out:
            raise ValueError(f"extension {s.name} is defined twice")
        out[s.name] = s
    return list(out.values())


def matches(spec: Spec, labels: Column) -> Column:
    return trigger(labels, spec.any_of, spec.all_of)


def validated(spec: Spec, response: Column) -> Column:
    """Of a map field -> values: known options by field, unknown values as unmapped, and a status. A single-valued field with several values, or with none known, is invalid."""
    parts, unknown, bad = [], [], F.lit(False)
    for name, options in spec.fields.items():
        raw = F.filter(F.coalesce(F.try_element_at(response, F.lit(name)), F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
        allowed = F.array(*[F.lit(o) for o in options])
        parts += [F.lit(name), F.array_intersect(raw, allowed)]
        unknown.append(F.transform(F.array_except(raw, allowed), _unmapped(name)))
        if name not in spec.multi:
            bad = bad | (F.size(raw) != 1) | (F.size(F.array_intersect(raw, allowed)) != 1)
    return F.struct(F.when(bad, "invalid").otherwise("success").alias("status"), F.create_map(*parts).alias("labels"), F.flatten(F.array(*unknown)).alias("unmapped"))


def _unmapped(name: str):  # noqa: ANN202
    return lambda v: F.struct(F.lit(name).alias("field"), v.alias("value"))


def field_counts(df: DataFrame) -> DataFrame:
    """``(spec, spec_hash, field, value, n)`` from long rows (spec, spec_hash, status, field, value); successful ones count."""
    return df.where("status = 'success'").groupBy("spec", "spec_hash", "field", "value").agg(F.count("*").alias("n"))


def status_counts(df: DataFrame, key: str) -> DataFrame:
    """``(spec, status, n)``: records by outcome."""
    return df.groupBy("spec", "status").agg(F.countDistinct(key).alias("n"))


def spec_rarity(df: DataFrame, key: str, baseline: DataFrame | None = None, min_total: int = 0) -> DataFrame:
    """``(key, spec, raw, score, confidence)`` of long rows (key, spec, spec_hash, status, field, value, confidence).

    Per field 0.6 max + 0.4 mean of its values' idf, shrunk to the field's mean idf by its confidence (default 0.75); per
    spec the mean over populated fields; its confidence is theirs times the share of populated fields. The baseline (rows of
    the same form, default ``df`` itself) is that of the same spec and hash; one below ``min_total`` records gives no score."""
    ok = (baseline or df).where("status = 'success'")
    total = ok.groupBy("spec", "spec_hash").agg(F.countDistinct(key).alias("total"), F.countDistinct("field").alias("n_fields"))
    t = ok.groupBy("spec", "spec_hash", "field", "value").agg(F.count("*").alias("n")).join(total, ["spec", "spec_hash"])
    t = t.withColumn("idf", idf(F.col("n"), F.col("total")))
    prior = t.groupBy("spec", "spec_hash", "field").agg(F.avg("idf").alias("prior"), F.first("total").alias("total"), F.first("n_fields").alias("n_fields"))
    own = df.where("status = 'success' and value is not null and value <> ''").join(prior, ["spec", "spec_hash", "field"]).join(t.select("spec", "spec_hash", "field", "value", "idf"), ["spec", "spec_hash", "field", "value"], "left")
    v = F.coalesce("idf", "prior")
    f = own.groupBy(key, "spec", "field").agg((0.6 * F.max(v) + 0.4 * F.avg(v)).alias("o"), F.max("prior").alias("prior"), F.coalesce(F.max("confidence"), F.lit(LABEL_CONFIDENCE_DEFAULT)).alias("c"), F.max("total").alias("total"), F.max("n_fields").alias("n_fields"))
    s = f.groupBy(key, "spec").agg(F.avg(F.col("c") * F.col("o") + (1 - F.col("c")) * F.col("prior")).alias("raw"), (F.avg("c") * F.count("*") / F.max("n_fields")).alias("confidence"), F.max("total").alias("total"))
    top = F.log2(F.greatest(F.col("total"), F.lit(2)))
    score = F.when(F.col("total") >= min_total, 1 + 9 * F.greatest(F.lit(0.0), F.least(F.col("raw"), top)) / top)
    return s.select(key, "spec", "raw", score.alias("score"), "confidence")


def sample_extension_rarity(per_spec: DataFrame, key: str) -> DataFrame:
    """``(key, score, confidence, specs)``: the confidence-weighted mean over a record's specs with a score."""
    w = F.greatest("confidence", F.lit(1e-9))
    return per_spec.where("score is not null").groupBy(key).agg((F.sum(F.col("score") * w) / F.sum(w)).alias("score"), F.avg("confidence").alias("confidence"), F.count("*").alias("specs"))


__all__ = ["Spec", "absolute", "field_counts", "load_specs", "matches", "sample_extension_rarity", "spec_rarity", "status_counts", "validated"]
