"""Labels as a long table, their canonical spelling, validation and rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.config import COMBO_CAPS, INHERITED_LABEL_FACTOR, LABEL_CONFIDENCE_DEFAULT, LOW_CONFIDENCE, MULTI_DIMS, SINGLE_DIMS

#: Tasks that fit the intents to build and to modify.
BUILD_TASKS = ("feature-implementation", "configuration", "schema-design", "deployment", "api-design", "testing-task", "documentation", "logging", "monitoring")
MODIFY_TASKS = ("code-refactoring", "code-optimization", "migration", "code-translation", "feature-implementation", "bug-fixing", "error-handling-task", "configuration", "documentation", "testing-task", "schema-design", "dependency-management")


def as_arrays(labels: Column, dims: Sequence[str] = (*SINGLE_DIMS, *MULTI_DIMS)) -> Column:
    """Each dimension as an array of its non-empty tags, in order and with repeats; a null struct gives empty arrays."""
    none = F.array().cast("array<string>")

    def arr(d: str) -> Column:
        c = labels.getField(d)
        return F.coalesce(F.filter(F.array(c) if d in SINGLE_DIMS else c, lambda x: x.isNotNull() & (x != "")), none)

    return F.struct(*[arr(d).alias(d) for d in dims])


def tags_long(df: DataFrame, keep: Sequence[str], labels: str = "labels", inherited: str | None = "inherited") -> DataFrame:
    """``keep`` columns, dim, tag, confidence: one row per tag of each record; a tag that stands twice comes twice.

    Confidence is the dimension's (default 0.75), times 0.65 where the labels are inherited, within 0..1. Records without
    labels have no rows."""
    lab = F.col(labels)
    entries = F.flatten(F.array(*[F.transform(as_arrays(lab)[d], _entry(d, F.try_element_at(lab["confidence"], F.lit(d)))) for d in (*SINGLE_DIMS, *MULTI_DIMS)]))
    out = df.where(lab.isNotNull()).select(*keep, *([inherited] if inherited and inherited not in keep else []), F.explode(entries).alias("e"))
    base = F.coalesce(F.when(~F.isnan("e.conf"), F.col("e.conf")), F.lit(LABEL_CONFIDENCE_DEFAULT))
    conf = F.when(F.coalesce(F.col(inherited), F.lit(False)), base * INHERITED_LABEL_FACTOR).otherwise(base) if inherited else base
    return out.select(*keep, F.col("e.dim").alias("dim"), F.col("e.tag").alias("tag"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf)).alias("confidence"))


def _entry(dim: str, conf: Column):  # noqa: ANN202
    return lambda t: F.struct(F.lit(dim).alias("dim"), t.alias("tag"), conf.alias("conf"))


def combo_key(labels: Column) -> Column:
    """``dim=v1,v2|...``: single labels, then the first few distinct sorted tags of each list; null without any."""
    arrays = as_arrays(labels)
    parts = [F.when(F.size(arrays[d]) > 0, F.concat(F.lit(f"{d}="), arrays[d][0])) for d in SINGLE_DIMS]
    parts += [F.when(F.size(arrays[d]) > 0, F.concat(F.lit(f"{d}="), F.array_join(F.slice(F.array_sort(F.array_distinct(arrays[d])), 1, COMBO_CAPS[d]), ","))) for d in MULTI_DIMS]
    key = F.concat_ws("|", *parts)
    return F.when(key != "", key)


def resolve_aliases(long: DataFrame, pool: DataFrame) -> DataFrame:
    """Adds canonical and how (pool, alias, rescue, unmapped) to rows with dim and tag.

    ``pool`` has dim, tag, aliases. A tag of the dimension's pool stays; else the dimension's alias; else, where exactly one
    other dimension's pool has the tag, it is rescued to that one (column owner); else it is unmapped."""
    known = pool.select(F.col("dim").alias("p_dim"), F.col("tag").alias("p_tag"))
    alias = pool.select(F.col("dim").alias("a_dim"), F.explode("aliases").alias("a_alias"), F.col("tag").alias("a_tag")).groupBy("a_dim", "a_alias").agg(F.min("a_tag").alias("a_tag"))
    owner = pool.groupBy(F.col("tag").alias("o_tag")).agg(F.min("dim").alias("o_dim"), F.countDistinct("dim").alias("o_n")).where("o_n = 1").select("o_tag", "o_dim")
    j = long.join(known, (F.col("dim") == F.col("p_dim")) & (F.col("tag") == F.col("p_tag")), "left")
    j = j.join(alias, (F.col("dim") == F.col("a_dim")) & (F.col("tag") == F.col("a_alias")), "left").join(owner, F.col("tag") == F.col("o_tag"), "left")
    how = F.when(F.col("p_tag").isNotNull(), "pool").when(F.col("a_tag").isNotNull(), "alias").when(F.col("o_dim").isNotNull(), "rescue").otherwise("unmapped")
    return j.select(*long.columns, F.coalesce("p_tag", "a_tag", "tag").alias("canonical"), F.when(how == "rescue", F.col("o_dim")).otherwise(F.col("dim")).alias("owner"), how.alias("how"))


def empty_sentinel(c: Column) -> Column:
    """Spellings that mean no tag."""
    return F.coalesce(F.lower(F.trim(c)).isin("", "none", "null", "n/a", "na", "unknown", "unspecified", "-") | F.lower(F.trim(c)).rlike("^(?:no specific|not specified|not applicable)"), F.lit(True))


def unmappable(c: Column) -> Column:
    """An unmapped tag is kept if it has at most 60 characters and 3 blanks."""
    return (F.length(c) <= 60) & (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) <= 3)


def clean_confidence(conf: Column) -> Column:
    return F.map_filter(conf, lambda k, v: v.isNotNull() & ~F.isnan(v) & v.between(0, 1))


def low_confidence_dims(conf: Column, below: float = LOW_CONFIDENCE) -> Column:
    return F.array_sort(F.map_keys(F.map_filter(clean_confidence(conf), lambda k, v: v < below)))


def consistency(labels: Column) -> Column:
    """Names of the rules that the labels break, in rule order."""
    a = as_arrays(labels)
    intent, difficulty, context = (F.coalesce(labels.getField(d), F.lit("")) for d in SINGLE_DIMS)

    def lacks(dim: str, tags: Sequence[str]) -> Column:
        return ~F.arrays_overlap(a[dim], F.array(*[F.lit(t) for t in tags]))

    def has(dim: str, tag: str) -> Column:
        return F.array_contains(a[dim], tag)

    rules = {
        "learn-many-agentic": (intent == "learn") & (F.size(a["agentic"]) > 3),
        "build-no-build-task": (intent == "build") & (F.size(a["task"]) > 0) & lacks("task", BUILD_TASKS),
        "beginner-many-concepts": (difficulty == "beginner") & (F.size(a["concept"]) > 3),
        "beginner-constraints": (difficulty == "beginner") & (F.size(a["constraint"]) > 0),
        "debug-no-bug-fixing": (intent == "debug") & (F.size(a["task"]) > 0) & lacks("task", ("bug-fixing",)),
        "expert-no-concepts": (difficulty == "expert") & (F.size(a["concept"]) == 0),
        "translation-one-language": has("task", "code-translation") & (F.size(a["language"]) < 2),
        "ownership-no-rust": has("concept", "ownership") & ~has("language", "rust"),
        "snippet-multi-file": (context == "snippet") & has("agentic", "multi-file-coordination"),
        "review-no-review-task": (intent == "review") & (F.size(a["task"]) > 0) & lacks("task", ("code-review-task",)),
        "modify-no-modify-task": (intent == "modify") & (F.size(a["task"]) > 0) & lacks("task", MODIFY_TASKS),
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))


def trigger(labels: Column, any_of: Mapping[str, Sequence[str]] | None = None, all_of: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Routing of an extension: every requirement holds; an empty requirement is ignored, missing labels never match."""
    a, out = as_arrays(labels), labels.isNotNull()
    for d, tags in (any_of or {}).items():
        if tags:
            out = out & F.arrays_overlap(a[d], F.array(*[F.lit(t) for t in tags]))
    for d, tags in (all_of or {}).items():
        if tags:
            out = out & (F.size(F.array_except(F.array(*[F.lit(t) for t in tags]), a[d])) == 0)
    return F.coalesce(out, F.lit(False))


def min_confidence(conf: Column) -> Column:
    """Struct (confidence, dim) of the least sure dimension, the first by name of equal ones; null without any."""
    return F.array_min(F.transform(F.map_entries(clean_confidence(conf)), lambda e: F.struct(e["value"].alias("confidence"), e["key"].alias("dim"))))


def flat_tags(labels: Column) -> Column:
    """All tags of a record, as ``tag`` and as ``dim:tag``, sorted without repeats; none without labels."""
    a = as_arrays(labels)
    named = [F.transform(a[d], _prefixed(d)) for d in (*SINGLE_DIMS, *MULTI_DIMS)]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[a[d] for d in (*SINGLE_DIMS, *MULTI_DIMS)], *named))))


def _prefixed(dim: str):  # noqa: ANN202
    return lambda t: F.concat(F.lit(dim + ":"), t)


def validate_scores(sub: Column, overall: Column, correctness: Column | None = None) -> Column:
    """A score within 1..10 as a whole number, else null; an overall over ``correctness`` + 2 becomes that; then one more
    than 2 from the mean of its parts becomes the mean, rounded half to even."""
    ok = lambda c: F.when(c.between(1, 10), c.cast("int"))
    total = ok(overall)
    if correctness is not None:
        total = F.when(total > ok(correctness) + 2, ok(correctness) + 2).otherwise(total)
    parts = F.filter(F.transform(sub, ok), lambda x: x.isNotNull())
    mean = F.aggregate(parts, F.lit(0.0), lambda x, y: x + y) / F.size(parts)
    return F.when((F.size(parts) > 0) & (F.abs(total - mean) > 2), F.bround(mean, 0).cast("int")).otherwise(total)


def known_flags(flags: Column, known: Sequence[str]) -> Column:
    """Struct (known, unknown) of a list of flags; null flags are left out."""
    have = F.array(*[F.lit(k) for k in known])
    some = F.filter(F.coalesce(flags, F.array().cast("array<string>")), lambda f: f.isNotNull())
    return F.struct(F.filter(some, lambda f: F.array_contains(have, f)).alias("known"), F.filter(some, lambda f: ~F.array_contains(have, f)).alias("unknown"))


def pool_issues(pool: DataFrame, dims: Sequence[str] = (*SINGLE_DIMS, *MULTI_DIMS), most: int = 200) -> DataFrame:
    """``(issue, name)``: tags without dimension or name, of an unknown dimension, without subcategory where others of their
    dimension have one, subcategories that stand in several dimensions, aliases with capital letters or over ``most`` characters."""
    grouped = pool.where("subcategory is not null").select(F.col("dim").alias("_d")).distinct()
    lacking = pool.where("subcategory is null").join(grouped, F.col("dim") == F.col("_d"), "left_semi").select(F.lit("lacks-subcategory").alias("issue"), F.col("tag").alias("name"))
    missing = pool.where("tag is null or tag = '' or dim is null or dim = ''").select(F.lit("lacks-required-field").alias("issue"), F.coalesce("tag", F.lit("")).alias("name"))
    unknown = pool.where(~F.col("dim").isin(*dims)).select(F.lit("unknown-dimension").alias("issue"), F.col("tag").alias("name"))
    shared = pool.where("subcategory is not null").groupBy("subcategory").agg(F.countDistinct("dim").alias("n")).where("n > 1").select(F.lit("subcategory-in-several-dims").alias("issue"), F.col("subcategory").alias("name"))
    al = pool.select(F.explode("aliases").alias("alias")).where("alias is not null")
    case = al.where(F.col("alias") != F.lower("alias")).select(F.lit("alias-not-lowercase").alias("issue"), F.col("alias").alias("name"))
    long_ = al.where(F.length("alias") > most).select(F.lit("alias-too-long").alias("issue"), F.col("alias").alias("name"))
    return missing.unionByName(unknown).unionByName(lacking).unionByName(shared).unionByName(case).unionByName(long_)


def guessed_dimension(values: DataFrame, pool: DataFrame, value: str = "value") -> DataFrame:
    """Adds guess: the first dimension by name whose pool has the value as tag or alias; null if none has."""
    names = pool.select("dim", F.explode(F.concat(F.array("tag"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("_n")).groupBy("_n").agg(F.min("dim").alias("guess"))
    return values.join(names, F.col(value) == F.col("_n"), "left").drop("_n")


def taxonomy_issues(pool: DataFrame) -> DataFrame:
    """``(issue, name, n)``: tags of several dimensions, aliases of several tags, aliases that are tags, empty subcategories, subcategories with over 80 % of their dimension."""
    multi = pool.groupBy("tag").agg(F.countDistinct("dim").alias("n")).where("n > 1").select(F.lit("tag-in-several-dims").alias("issue"), F.col("tag").alias("name"), "n")
    al = pool.select("dim", "tag", F.explode("aliases").alias("alias"))
    dup = al.groupBy("alias").agg(F.countDistinct("dim", "tag").alias("n")).where("n > 1").select(F.lit("alias-of-several-tags").alias("issue"), F.col("alias").alias("name"), "n")
    both = al.join(pool.select(F.col("tag").alias("t")).distinct(), F.col("alias") == F.col("t")).groupBy("alias").agg(F.count("*").alias("n")).select(F.lit("alias-is-tag").alias("issue"), F.col("alias").alias("name"), "n")
    none = pool.where(F.col("subcategory").isNull()).groupBy("dim").agg(F.count("*").alias("n")).select(F.lit("no-subcategory").alias("issue"), F.col("dim").alias("name"), "n")
    tot = pool.groupBy("dim").agg(F.count("*").alias("all"))
    much = pool.where(F.col("subcategory").isNotNull()).groupBy("dim", "subcategory").agg(F.count("*").alias("n")).join(tot, "dim").where("n > 0.8 * all").select(F.lit("dominant-subcategory").alias("issue"), F.concat_ws("/", "dim", "subcategory").alias("name"), "n")
    return multi.unionByName(dup).unionByName(both).unionByName(none).unionByName(much)
