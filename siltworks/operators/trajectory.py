"""Structure of a conversation's trajectory: tools, files, tests and edits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns: what shows tests, edits and file references; names of shell tools.
TESTS = r"(?i)\b(?:pytest|unittest|go\s+test|cargo\s+test|npm\s+test|pnpm\s+test|yarn\s+test|vitest|jest|mocha|ctest|gradle\s+test|mvn\s+test|phpunit|rspec|tox|nosetests|test|tests|testing)\b"
EDITS = r"(?i)apply_patch|str_replace_editor|write_file|cat\s+>\s+|tee\s+|patch\b|diff --git|\*\*\* Update File:|\*\*\* Add File:|\*\*\* Delete File:|sed\s+-i\b|perl\s+-pi\b|\bpatched?\b"
PATHS = r"(?<![\w.-])((?:\.{1,2}/|/)?(?:[\w.-]+/)+[\w.-]+)"
FILES = r"(?i)(?<![/\w.-])([\w.-]+\.(?:py|pyi|js|jsx|ts|tsx|go|rs|java|kt|scala|rb|php|c|cc|cpp|h|hpp|cs|swift|m|mm|sql|ya?ml|json|toml|ini|cfg|conf|md|sh|zsh|bash|ps1|xml|html|css|gradle))(?![\w.-])"
SHELL_TOOLS = ("bash", "execute_bash", "shell", "terminal", "command", "run_shell_command", "run_command")


def tool_names(text: Column) -> Column:
    """Names in tagged tool calls."""
    calls = F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"), 1)
    return F.array_compact(F.transform(calls, lambda c: F.coalesce(F.get_json_object(c, "$.name"), F.get_json_object(c, "$.function.name"))))


def file_refs(text: Column) -> Column:
    """Paths and file names that a text mentions."""
    found = F.concat(F.regexp_extract_all(text, F.lit(PATHS), 1), F.regexp_extract_all(text, F.lit(FILES), 1))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.regexp_replace(x, r"^[`'\"()\[\]{}:;,]+|[`'\"()\[\]{}:;,]+$", "")), lambda x: ~x.isin("", ".", "..", "/")))


def structure(ts: Column) -> Column:
    """Counts over the turns of a whole conversation."""
    named = F.transform(ts, lambda t: tool_names(t["value"]))
    n = F.size(ts)
    tool = F.size(F.filter(ts, lambda t: (t["from"] == "tool") | (F.size(tool_names(t["value"])) > 0)))
    hits = lambda p: F.size(F.filter(ts, lambda t: t["value"].rlike(p)))
    return F.struct(
        tool.alias("tool_turns"), F.when(n > 0, tool / n).otherwise(0.0).alias("tool_ratio"), F.array_sort(F.array_distinct(F.flatten(named))).alias("tools"),
        F.size(F.array_distinct(F.flatten(F.transform(ts, lambda t: file_refs(t["value"]))))).alias("files"), hits(TESTS).alias("test_turns"), hits(EDITS).alias("edit_turns"),
        F.size(F.filter(ts, lambda t: F.startswith(F.ltrim(t["value"]), F.lit("$ ")) | F.exists(tool_names(t["value"]), lambda n: F.lower(n).isin(*SHELL_TOOLS)))).alias("shell_turns"), F.size(F.filter(ts, lambda t: t["from"] == "gpt")).alias("replies"),
        F.coalesce(F.try_element_at(ts, F.lit(-1))["from"], F.lit("")).alias("final_role"),
    )
