"""The boundary to external labelers and scorers, and the local features around it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import let, segments

#: Markers by which a slice shows what stage of work it belongs to.
SUMMARY = ("## summary", "summary", "final review", "changes made", "what i implemented", "implemented the requested", "successfully implemented", "here's a summary")
ROOT_CAUSE = ("root cause", "caused by", "this issue was caused", "the bug was", "the failure was due")
FIX = ("added", "updated", "changed", "removed", "fixed", "implemented", "refactored", "renamed", "patched", "handled")
VERIFICATION = ("pytest", "test", "tests passed", "verified", "verification", "regression", "exit code: 0", "all tests pass", "passes now", "confirmed")
#: Fixed patterns: file paths, symbols, tool calls, tool use that tells little.
FILE_PATH = r"(?i)(?:(?:/workspace/)?[\w./-]+\.(?:py|pyi|js|jsx|ts|tsx|java|go|rs|sql|yml|yaml|json|toml|ini|cfg|c|cc|cpp|h|hpp|cs|rb|php|swift|kt|scala))"
SYMBOL = r"(?i)`?[A-Za-z_][\w.]{2,}`?\s*(?:\(|class\b|def\b|method\b|function\b)"
TOOL_CALL = r"(?i)<tool_call>|\"name\"\s*:\s*\"[^\"]+\""
LOW_INFO = r"(?i)\b(view|grep|ls|find|pwd|tree|cat|head|tail|sed|awk|pip install|npm install|poetry install|pytest)\b"
#: Words that point to a domain; those that make one of them sure.
DOMAIN_HINTS = {
    "compiler-development": ("compiler", "parser", "lexer", "token", "ast", "bytecode", "transpile", "transpilation", "interpreter", "macro", "typecheck"),
    "machine-learning": ("pytorch", "tensorflow", "torch", "tensor", "epoch_length", "optimizer", "training", "inference", "dataloader", "gradient", "loss"),
    "cloud-computing": ("aws", "gcp", "azure", "cloud storage", "storage api", "lambda", "iam", "bigquery", "s3", "gcs", "pubsub"),
    "api-development": ("api", "endpoint", "request", "response", "rest", "graphql", "dbapi", "header"),
    "devops": ("docker", "kubernetes", "helm", "terraform", "github actions", "jenkins", "ci", "cd", "deploy", "build profile"),
}
API_CONTEXT = ("endpoint", "request", "response", "rest", "graphql", "dbapi")
CLOUD_SERVICES = ("bigquery", "storage api", "s3", "gcs", "lambda", "iam")
#: Arguments by which a tool call locates its work.
LOCATING_ARGUMENTS = ("command", "file", "file_path", "path", "q", "query", "target", "target_file", "uri", "url")


def _hits(text: Column, words: tuple[str, ...]) -> Column:
    low = F.lower(text)
    return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))


def stage_features(ts: Column) -> Column:
    """What a slice's text says of its stage: evidence, summary and verification hits, tool density, low-information tool use."""

    def of(s: Column) -> Column:
        resp, traj = s["response"], s["trajectory"]
        both = F.concat_ws("\n", s["request"], traj, resp)
        files, symbols = resp.rlike(FILE_PATH), resp.rlike(SYMBOL)
        cause, fix, ver = _hits(resp, ROOT_CAUSE) > 0, _hits(resp, FIX) > 0, _hits(resp, VERIFICATION) > 0
        kinds = sum((c.cast("int") for c in (files, symbols, cause, fix, ver)), F.lit(0))
        evidence = (kinds >= 2) | (files & (fix | ver))
        tool_like = resp.rlike(TOOL_CALL) | traj.rlike(TOOL_CALL)
        action = F.concat_ws("\n", resp, traj).rlike(LOW_INFO)
        few = F.regexp_count(resp, F.lit("[A-Za-z_]{2,}")) < 80
        only = tool_like & (F.startswith(F.ltrim(resp), F.lit("{")) | F.startswith(F.ltrim(resp), F.lit("<tool_call>")))
        low = few & action & (only | (tool_like & ~evidence))
        density = F.when(s["n_trajectory"] > 0, s["n_tools"] / s["n_trajectory"]).otherwise(0.0)
        return F.struct(evidence.alias("evidence"), low.alias("low_info"), _hits(resp, SUMMARY).alias("summary_hits"), _hits(both, VERIFICATION).alias("verification_hits"), density.alias("tool_density"), (traj != "").alias("has_trajectory"), kinds.alias("evidence_kinds"))

    return let(segments(ts), of)


def domain_backfill(ts: Column, domains: Column) -> Column:
    """The domains as they are; where there are none, the one that the text points to: at least 3 points and more than any other."""

    def of(s: Column) -> Column:
        text = F.lower(F.concat_ws("\n", s["request"], s["trajectory"], s["response"]))
        some = lambda ws: F.exists(F.array(*[F.lit(w) for w in ws]), lambda w: F.contains(text, w))
        scores = []
        for d, words in DOMAIN_HINTS.items():
            n = sum((F.contains(text, F.lit(w)).cast("int") * (2 if len(w) > 6 else 1) for w in words), F.lit(0))
            if d == "api-development":
                n = F.when(F.contains(text, F.lit("api")), F.when(some(API_CONTEXT), n + 1).otherwise(F.greatest(n - 1, F.lit(0)))).otherwise(n)
            if d == "cloud-computing":
                n = n + F.when(some(CLOUD_SERVICES), 2).otherwise(0)
            scores.append(F.struct((-n).alias("n"), F.lit(d).alias("d")))
        return F.array_sort(F.array(*scores))

    def pick(o: Column) -> Column:
        clear = (o[0]["n"] <= -3) & (o[0]["n"] < o[1]["n"])
        return F.when(clear, F.array(o[0]["d"])).otherwise(F.array().cast("array<string>"))

    return F.when(F.size(domains) > 0, domains).otherwise(let(let(segments(ts), of), pick))


def external(df: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 64) -> DataFrame:
    """A user's labeler or scorer over Arrow batches: ``call`` takes at most ``batch`` rows and returns rows of ``schema``.

    Its errors fail the task, which Spark retries; a call that must not be repeated should write by key."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i in range(0, len(f), batch):
                yield call(f.iloc[i : i + batch])

    return df.mapInPandas(run, schema)


def tool_signature(payload: Column) -> Column:
    """``name:arguments`` of a tool call in JSON; the arguments that locate the work, or all if there are none of these."""
    name = F.coalesce(F.nullif(F.get_json_object(payload, "$.name"), F.lit("")), F.get_json_object(payload, "$.function.name"))
    args = F.coalesce(*[F.get_json_object(payload, f"$.{k}") for k in ("arguments", "parameters", "args")])
    found = F.array_compact(F.array(*[F.when(F.get_json_object(args, f"$.{k}").isNotNull(), F.concat(F.lit(f'"{k}": '), F.to_json(F.array(F.get_json_object(args, f"$.{k}"))))) for k in LOCATING_ARGUMENTS]))
    return F.when(name.isNotNull() & (name != ""), F.concat(name, F.lit(":"), F.when(F.size(found) > 0, F.concat(F.lit("{"), F.array_join(found, ", "), F.lit("}"))).otherwise(F.coalesce(args, F.lit("{}")))))


def compare_selection(before: DataFrame, after: DataFrame, key: str, score: str = "selection") -> DataFrame:
    """``(key, before, after, delta)`` of two scorings; records that one of them lacks are left out."""
    b = before.select(key, F.col(score).alias("before"))
    return b.join(after.select(key, F.col(score).alias("after")), key).withColumn("delta", F.coalesce("after", F.lit(0.0)) - F.coalesce("before", F.lit(0.0)))


def threshold_shift(compared: DataFrame) -> DataFrame:
    """One row: how many records reach 8 and how many stay at 3 or below, before and after."""
    n = lambda c, cond: F.count_if(cond(F.col(c)))
    return compared.agg(F.count("*").alias("n"), n("before", lambda c: c >= 8).alias("before_ge_8"), n("after", lambda c: c >= 8).alias("after_ge_8"), n("before", lambda c: c <= 3).alias("before_le_3"), n("after", lambda c: c <= 3).alias("after_le_3"))
