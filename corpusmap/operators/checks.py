"""Row-level rules. Each check is one aggregate pass and returns ``rule, field, n``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from corpusmap.functions import text, vectors

# The longest string id, and the largest number of values of a category.
MAX_ID_LENGTH = 36
MAX_CATEGORIES = 10
CATEGORY_NAMES = ("class", "label", "target")
# Estimates beyond this are surely beyond MAX_CATEGORIES.
_SURELY_MANY = 100


class RowError(ValueError):
    """Rows break one or more rules; ``problems`` lists (rule, field, n)."""

    def __init__(self, problems: list[tuple[str, str, int]]):
        self.problems = problems
        super().__init__("; ".join(f"{rule} in {field}: {n}" for rule, field, n in problems))


def report(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate aggregate expressions in one pass, as one row per rule."""
    totals = df.agg(*[e.cast("bigint").alias(f"_r{i}") for i, (_, _, e) in enumerate(rules)])
    lines = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(field).alias("field"), F.col(f"_r{i}").alias("n"))
            for i, (rule, field, _) in enumerate(rules)
        ]
    )
    return totals.select(F.explode(lines).alias("line")).select("line.*")


def enforce(found: DataFrame) -> None:
    """Raise if a report has a broken rule. A report has one row per rule."""
    broken = [(r.rule, r.field, r.n) for r in found.filter(F.col("n") > 0).toLocalIterator()]
    if broken:
        raise RowError(broken)


def watched(df: DataFrame, rules: list[tuple[str, str, Column]]) -> tuple[DataFrame, Observation]:
    """``df`` whose rules are evaluated by the job that consumes it, without a pass of their own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.coalesce(e.cast("bigint"), F.lit(0)).alias(f"r{i}") for i, (_, _, e) in enumerate(rules)]), seen


def broken(seen: Observation, rules: list[tuple[str, str, Column]]) -> list[tuple[str, str, int]]:
    """The rules that rows of a finished job broke."""
    found = seen.get
    return [(rule, field, found[f"r{i}"]) for i, (rule, field, _) in enumerate(rules) if found[f"r{i}"]]


def id_rules(field: str) -> list[tuple[str, str, Column]]:
    c = F.col(f"`{field}`")
    return [
        ("null id", field, F.count_if(c.isNull())),
        ("id too long", field, F.count_if(F.char_length(c.cast("string")) > MAX_ID_LENGTH)),
    ]


def validate_ids(df: DataFrame, field: str) -> DataFrame:
    return report(df, id_rules(field))


def validate_vectors(df: DataFrame, field: str, half: bool = False) -> DataFrame:
    """No rows, differing lengths, unusable components, and (if half) half-precision overflow."""
    return report(df, vector_rules(field, half))


def vector_rules(field: str, half: bool = False) -> list[tuple[str, str, Column]]:
    c = F.col(f"`{field}`")
    rules = [
        ("no rows", field, (F.count(F.lit(1)) == 0).cast("int")),
        ("null vector", field, F.count_if(c.isNull())),
        (
            "lengths differ",
            field,
            F.coalesce((F.min(F.size(c)) != F.max(F.size(c))).cast("int"), F.lit(0)),
        ),
        ("invalid component", field, F.count_if(vectors.has_invalid(c))),
    ]
    if half:
        rules.append(("half overflow", field, F.count_if(vectors.overflows_half(c))))
    return rules


def profile(df: DataFrame) -> DataFrame:
    """Per column: ``field, rows, nulls, empties, max_length`` from one pass."""
    per_column = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        is_text = f.dataType.typeName() == "string"
        per_column.append(
            F.struct(
                F.lit(f.name).alias("field"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(c.isNull()).alias("nulls"),
                (F.count_if(c == "") if is_text else F.lit(0).cast("bigint")).alias("empties"),
                (F.max(F.char_length(c)).cast("bigint") if is_text else F.lit(None).cast("bigint")).alias(
                    "max_length"
                ),
            )
        )
    return df.agg(F.array(*per_column).alias("columns")).select(F.inline("columns"))


def few_valued(df: DataFrame, fields: list[str], most: int = MAX_CATEGORIES) -> dict[str, bool]:
    """Which fields have at most ``most`` distinct values.

    A sketch pass rules out the columns with far more values, so the exact pass only ever
    shuffles a handful of values per task.
    """
    if not fields:
        return {}

    def plain(f):
        return F.col(f"`{f}`")

    rough = df.agg(*[F.approx_count_distinct(plain(f)).alias(str(i)) for i, f in enumerate(fields)]).first()
    maybe = [f for i, f in enumerate(fields) if rough[i] <= max(_SURELY_MANY, 10 * most)]
    result = dict.fromkeys(fields, False)
    if maybe:
        # Sets stay small after the sketch; a null counts as a value of its own.
        exact = df.agg(
            *[
                (F.size(F.collect_set(plain(f))) + F.max(plain(f).isNull().cast("int"))).alias(str(i))
                for i, f in enumerate(maybe)
            ]
        ).first()
        result.update({f: (exact[i] or 0) <= most for i, f in enumerate(maybe)})
    return result


def infer_color_fields(df: DataFrame, id_field: str = "id") -> DataFrame:
    """``field, numeric, named, few_values, color`` for every column but the id."""
    fields = [f for f in df.schema.fields if f.name != id_field]
    few = few_valued(df, [f.name for f in fields])
    rows = []
    for f in fields:
        numeric = f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")
        named = f.name in CATEGORY_NAMES
        rows.append((f.name, numeric, named, few[f.name], numeric or named or few[f.name]))
    return df.sparkSession.createDataFrame(
        rows, "field string, numeric boolean, named boolean, few_values boolean, color boolean"
    )


def stringify_few_valued(df: DataFrame, id_field: str = "id") -> DataFrame:
    """Columns with few distinct values as strings."""
    few = few_valued(df, [c for c in df.columns if c != id_field])
    return df.withColumns({f: F.col(f"`{f}`").cast("string") for f, yes in few.items() if yes})


def unbatch(df: DataFrame, vector_field: str, fields: list[str]) -> DataFrame:
    """Logged batches (an array of vectors, arrays of values) as one row per vector.

    A scalar value stands for a batch of one. Fails on batches whose lengths differ.
    """
    parts = []
    for f in fields:
        c = F.col(f"`{f}`")
        parts.append((c if df.schema[f].dataType.typeName() == "array" else F.array(c)).alias(f))
    expected = F.size(F.col(vector_field))
    same = F.lit(True)
    for p in parts:
        same = same & (F.size(p) == expected)
    checked = F.when(same, F.arrays_zip(F.col(vector_field), *parts)).otherwise(
        F.raise_error(F.lit("values and vectors of a batch differ in number"))
    )
    rest = [c for c in df.columns if c != vector_field and c not in fields]
    return df.select(*rest, F.inline(checked))


def slug_report(df: DataFrame, field: str) -> DataFrame:
    """Normalised keys of a column: ``slug, n, invalid``; a collision has n > 1."""
    c = F.col(f"`{field}`")
    return df.groupBy(text.slug_identifier(c).alias("slug")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~text.is_identifier(c)).alias("invalid")
    )
