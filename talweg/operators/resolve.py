"""Search, lookup and comparison of places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.text import letters_digits
from talweg.operators.stages import cut


def search(df: DataFrame, contains: dict[str, str] | None = None, lower: dict[str, str] | None = None, upper: dict[str, str] | None = None, number: dict[str, float] | None = None, either: tuple[tuple[str, ...], str] | None = None) -> DataFrame:
    """Rows that meet every condition given: plain substrings and equality without regard to case, numbers after a tolerant cast; null never matches."""
    for column, value in (contains or {}).items():
        df = df.filter(F.coalesce(F.lower(column).contains(value.lower()), F.lit(False)))
    for column, value in (lower or {}).items():
        df = df.filter(F.lower(column) == value.lower())
    for column, value in (upper or {}).items():
        df = df.filter(F.upper(column) == value.upper())
    for column, value in (number or {}).items():
        df = df.filter(F.col(column).cast("string").try_cast("double") == float(value))
    if either:
        found = F.lit(False)
        for column in either[0]:
            found = found | F.coalesce(F.lower(column).contains(either[1].lower()), F.lit(False))
        df = df.filter(found)
    return df


def resolve(asked: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """asked (key, code text, name) against known (code, name): found, missing, or ambiguous with the number of candidates. All that is given must hold."""
    a = asked.select(key, F.col("code").try_cast("double").alias("__code"), F.lower(F.trim("name")).alias("__name"))
    k = known.select(F.col("code").alias("k_code"), F.lower(F.trim("name")).alias("k_name"))
    by_code = a.filter("__code IS NOT NULL").join(k, F.col("__code") == F.col("k_code")).filter("__name IS NULL OR __name = k_name")
    by_name = a.filter("__code IS NULL").join(k, F.col("__name") == F.col("k_name"))
    found = by_code.select(key, "k_code").union(by_name.select(key, "k_code")).groupBy(key).agg(F.count("*").alias("n"), F.min("k_code").alias("c"))
    n = F.coalesce("n", F.lit(0))
    return asked.join(found, key, "left").select(*asked.columns, F.when(n == 0, "missing").when(n == 1, "found").otherwise("ambiguous").alias("status"), F.when(n == 1, F.col("c")).alias("found_code"), n.alias("candidates"))


def _parts(name: str, lengths: list[int], proper: bool = False) -> Column:
    """Rows of the distinct parts of a name that have one of the lengths; `proper`: shorter than the name."""
    long = F.col(name)
    part = lambda n: F.transform(F.sequence(F.lit(1), F.length(long) - n + 1), lambda i: F.substring(long, i, n))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: (n < F.length(long)) if proper else (n <= F.length(long)))
    return F.explode(F.array_distinct(F.flatten(F.transform(fits, part))))


def match_port(asked: DataFrame, ports: DataFrame, key: str, wanted: str, port: str) -> DataFrame:
    """The port whose letters and digits hold those of the wanted name, or the other way round; several are ambiguous.

    No pairs are formed: a name holds another if one of its parts of that length is the other. Parts of equal letters are
    counted before they meet the names, so that names which many hold are a row as well. Null finds nothing.
    """
    w = cut(asked.select(key, letters_digits(F.col(wanted)).alias("__w")))
    p = cut(ports.select(F.col(port).alias("__port"), letters_digits(F.col(port)).alias("__p")).filter("__p IS NOT NULL").groupBy("__p").agg(F.count("__port").alias("n"), F.min("__port").alias("port")))
    names = w.filter("__w IS NOT NULL").select("__w").distinct()
    lengths = lambda df, c: sorted(r[0] for r in df.select(F.length(c)).distinct().collect())
    counted = lambda df: df.groupBy("__w").agg(F.sum("n").alias("n"), F.min("port").alias("port"))
    inside = counted(p.select(_parts("__p", lengths(names, "__w")).alias("__w"), "n", "port"))
    around = counted(names.select("__w", _parts("__w", lengths(p, "__p"), True).alias("__p")).join(p, "__p"))
    hits = counted(inside.unionByName(around))
    found = w.join(hits, "__w", "left").groupBy(key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("port").alias("p"))
    return found.select(key, F.when(F.col("n") == 0, "missing").when(F.col("n") == 1, "found").otherwise("ambiguous").alias("status"), F.when(F.col("n") == 1, F.col("p")).alias(port))


def band(value: Column, bounds: list[float]) -> Column:
    """The number of the first bound that the value does not exceed; null is -1."""
    out = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        out = F.when(value <= bounds[i], i).otherwise(out)
    return F.when(value.isNull() | F.isnan(value), -1).otherwise(out)


def comparison(df: DataFrame, weights: dict[str, float], key: str = "district_code", group: str = "state") -> DataFrame:
    """Districts compared: percentiles over all and within the state, a weighted score over the metrics that are there, the rank."""
    scale = sum(weights.values())
    pct = lambda c, *by: F.when(F.col(c).isNotNull(), F.percent_rank().over(Window.partitionBy(*by, F.col(c).isNull()).orderBy(c)) * 100)
    df = df.withColumns({f"n_{c}": pct(c) for c in weights} | {f"s_{c}": pct(c, group) for c in weights})
    total, used = F.lit(0.0), F.lit(0.0)
    for c, w in weights.items():
        total = total + F.coalesce(F.col(f"n_{c}") * (w / scale), F.lit(0.0))
        used = used + F.when(F.col(f"n_{c}").isNotNull(), w / scale).otherwise(0.0)
    df = df.withColumn("__score", F.when(used > 0, total / used))
    rank = F.rank().over(Window.orderBy(F.round("__score", 9).desc_nulls_last()))  # one row per district of a country
    first = next(iter(weights))
    return df.select(key, F.round(f"n_{first}", 4).alias(f"{first}_national"), F.round(f"s_{first}", 4).alias(f"{first}_state"), F.round("__score", 4).alias("score"), rank.alias("rank"))
