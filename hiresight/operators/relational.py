"""Conform, union, keep-first dedup, filters and global-scalar fills.

All operators are DataFrame -> DataFrame.  Column choices that depend on the
input schema ("first existing name wins") are made at plan time from
``df.columns``; nothing is decided per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import IT_KEYWORDS
from ..functions.salary import safe_numeric
from ..functions.text import contains_any
from .quantiles import exact_quantiles

# alternatives per unified column, first existing wins
CONFORM_ALTERNATIVES = {
    "title": ["job_title", "title"],
    "company": ["company"],
    "city_raw": ["location", "city", "city_raw"],
    "exp_raw": ["experience", "exp", "exp_raw"],
    "working_form": ["working form", "working_form"],
}
# Unicode's white space (what (?U)\\s matches); trimming it off is far cheaper than a pattern
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
DESCRIPTION_PARTS = ["job_description", "description", "qualifications", "requirements"]
UNIFIED_COLUMNS = ["title", "company", "city_raw", "salary_min", "salary_max", "exp_raw",
                   "description", "working_form", "source"]


def first_existing(df: DataFrame, names) -> str | None:
    for n in names:
        if n in df.columns:
            return n
    return None


def concat_text(df: DataFrame, parts=DESCRIPTION_PARTS) -> Column:
    """strip(' ' + a + ' ' + b ...) over the existing parts; nulls count as ''.

    Not concat_ws: that would skip nulls and change the spacing between parts.
    """
    pieces = []
    for p in parts:
        if p in df.columns:
            pieces += [F.lit(" "), F.coalesce(F.col(f"`{p}`").cast("string"), F.lit(""))]
    if not pieces:
        return F.lit("")
    return F.btrim(F.concat(*pieces), F.lit(WHITE_SPACE))


def conform_schema(df: DataFrame, source=None, keep=("post_id", "source_rank", "source_url")) -> DataFrame:
    """Map one feed to the unified 9-column posting record.

    ``source`` is a literal label (tag_source) or None to keep an existing
    ``source`` column.  Columns in ``keep`` are passed through when present.
    """
    cols = [c for c in keep if c in df.columns]
    out = [F.col(c) for c in cols]
    for target, alts in CONFORM_ALTERNATIVES.items():
        name = first_existing(df, alts)
        val = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) if name else F.lit("")
        out.append(val.alias(target))
    out.append((safe_numeric(F.col("salary_min")) if "salary_min" in df.columns
                else F.lit(None).cast("double")).alias("salary_min"))
    max_name = first_existing(df, ["salarry_max", "salary_max"])
    out.append((safe_numeric(F.col(max_name)) if max_name else F.lit(None).cast("double")).alias("salary_max"))
    out.append(concat_text(df).alias("description"))
    out.append((F.lit(source) if source is not None else F.col("source")).alias("source"))
    res = df.select(*out)
    return res.select(*cols, *UNIFIED_COLUMNS)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Bag union by name (missing columns null), tagging each feed's rank."""
    ranked = [f.withColumn("source_rank", F.lit(i)) if "source_rank" not in f.columns else f
              for i, f in enumerate(feeds)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


RANK_BITS = 56


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """The row with the smallest ``order`` = (rank, id) of each combination of
    ``keys``; ids are unique within a rank.

    (rank, id) is packed into one long, so the winners are a hash aggregate of
    narrow rows (combined map-side: a hot key costs one row per map task), and
    a semi-join with them as the build side streams the wide rows past.
    Unselected columns stay unread.  Ids must lie in [0, 2^56).
    """
    keys, (rank, key_id) = list(keys), list(order)
    i = F.col(f"`{key_id}`").cast("long")
    packed = (F.when(i.between(0, (1 << RANK_BITS) - 1), F.shiftleft(F.col(f"`{rank}`").cast("long"), RANK_BITS) + i)
              .otherwise(F.raise_error(F.lit("keep_first: id out of range")).cast("long")))
    first = (df.groupBy(*[F.col(f"`{k}`").alias(f"__{k}") for k in keys]).agg(F.min(packed).alias("__first")))
    on = F.col("__packed") == F.col("__first")
    for k in keys:
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`"))
    return df.withColumn("__packed", packed).join(first.hint("shuffle_hash"), on, "left_semi").drop("__packed")


def keep_first_of_equals(df: DataFrame, keys, order) -> DataFrame:
    """Like ``keep_first`` where whole ``order`` tuples may repeat: exactly one
    row per ``keys``, by ``min(struct(order..., rest...))``.

    The struct is wide and sorts map-side; for tables of bounded size."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(packed).alias("_first"))
    return agg.select(*[F.col(f"`{k}`") for k in keys], *[F.col("_first").getField(c).alias(c) for c in order + rest]) \
        .select(*[F.col(f"`{c}`") for c in df.columns])


def domain_text(df: DataFrame) -> Column:
    return F.lower(F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit(" "),
                            F.coalesce(F.col("description"), F.lit(""))))


def filter_domain(df: DataFrame, keywords=IT_KEYWORDS) -> DataFrame:
    """Keep postings whose lowered 'title description' contains any keyword."""
    return df.where(contains_any(domain_text(df), keywords))


def filter_salary_range(df: DataFrame, lo: float = 5, hi: float = 100, col: str = "salary") -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def filter_city(df: DataFrame, city: str, col: str = "city") -> DataFrame:
    """Equality filter; 'All' means no filter."""
    return df if city == "All" else df.where(F.col(col) == city)


def city_options(df: DataFrame, col: str = "city") -> DataFrame:
    """'All' first, then the sorted distinct cities (with their rank)."""
    cities = df.select(F.col(col).alias("city")).distinct()
    all_row = df.sparkSession.range(1).select(F.lit("All").alias("city"))
    return all_row.unionByName(cities).select(
        "city", F.when(F.col("city") == "All", 0).otherwise(1).alias("grp"))


def scalar(df: DataFrame, expr: Column) -> Column:
    """An uncorrelated scalar subquery over ``df`` as a Column (lazy, no join).

    Spark evaluates it once as its own job and inlines the value, so global
    statistics (medians, quantiles, totals) never need a cross join or a
    collect on the driver.
    """
    return df.select(expr).scalar()


def fill_missing_median(df: DataFrame, col: str = "salary", default: float = 20.0) -> DataFrame:
    """Nulls -> exact global median of the column (``default`` if it has no values).

    The median is found at once, by range refinement (``quantiles``)."""
    med = exact_quantiles(df, col, [0.5])[0]
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(default if med is None else med)))


def fill_zero(df: DataFrame, cols) -> DataFrame:
    return df.na.fill(0, subset=list(cols))


def trim_quantiles(df: DataFrame, col: str = "salary", lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    """Keep rows with p_lo <= x <= p_hi (exact, linearly interpolated quantiles, found at once by range refinement)."""
    low, high = exact_quantiles(df, col, [lo, hi])
    return df.where((F.col(col) >= F.lit(low)) & (F.col(col) <= F.lit(high)))


def anti_join_new(new: DataFrame, existing: DataFrame, key: str = "source_url") -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (resume / incremental)."""
    return new.join(existing.select(key).distinct(), key, "left_anti")


def split_dead_letter(df: DataFrame, error_col: str = "error"):
    """(good rows, failed rows) by an error column."""
    return df.where(F.col(error_col).isNull()), df.where(F.col(error_col).isNotNull())
