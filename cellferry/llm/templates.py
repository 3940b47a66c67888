"""Removal of lines that recur across documents, by a tree of log templates.

The tree has a fixed depth: a line goes down by its number of tokens, then by its ``depth`` leading
tokens, where a token with a digit counts as a variable field. A leaf holds

* the line with its variable fields masked, which is a template by itself, and
* general templates: the tokens are cut into at most ``SEGMENTS`` runs, and lines of which enough runs
  agree are linked, as are those that agree enough with the most frequent value of each run. Linked
  lines make up one template, so a leaf has as many as it needs. Lines meet by the runs that must
  agree: each choice of so many runs is a key, so no pairs are compared.

A template recurs if at least ``documents`` different texts have it; all its lines but the first, in
order of id and line, are dropped. Every step counts with partial aggregation, so a line that a
third of all documents share brings one row per task to its place.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small_enough
from .components import components
from .fingerprints import UNSPACED

SEGMENTS = 8
VARIABLE = "<*>"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _apart(line: Column) -> Column:
    """The line with blanks around every character of a script without spaces.

    All such scripts lie above U+0E00: of other characters, no script is looked up.
    """
    spaced = F.regexp_replace(line, rf"([\x{{0E00}}-\x{{10FFFF}}&&[{UNSPACED}]])", " $1 ")
    return F.when(F.length(line) == F.octet_length(line), line).otherwise(spaced)


def _tokens(apart: Column) -> Column:
    """The tokens of such a line, those with a digit as a variable field, unless nothing constant would be left."""
    masked = F.regexp_replace(apart, r"(?<!\S)[^\s0-9]*+[0-9]\S*+", VARIABLE)
    # a token without a digit that is more than fields written out
    constant = apart.rlike(r"(?<!\S)(?!(?:<\*>)++(?!\S))[^\s0-9]++(?!\S)")
    return F.split(F.trim(F.when(apart.rlike("[0-9]") & constant, masked).otherwise(apart)), r"\s+")


def _segments(tokens: Column) -> Column:
    """Hashes of at most ``SEGMENTS`` runs of tokens, of nearly equal length."""
    n, k = F.size(tokens), F.least(F.lit(SEGMENTS), F.size(tokens))

    def start(i: Column) -> Column:
        return F.floor(i * n / k).cast("int")

    return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.xxhash64(F.slice(tokens, start(i) + 1, start(i + 1) - start(i))))


def _same(n: Column, depth: int) -> Column:
    """How many runs lie within the leading tokens, which are equal in a leaf."""
    k = F.least(F.lit(SEGMENTS), n)
    return sum((F.when((k >= i) & (F.floor(F.lit(i) * n / k) <= depth), 1).otherwise(0) for i in range(1, SEGMENTS + 1)), F.lit(0))


def _keys(similar: float, depth: int) -> Column:
    """A key for each choice of runs that must agree; two lines of a leaf agree enough if they share one."""
    made = F.array().cast("array<struct<k1:bigint,k2:int>>")
    for k in range(1, SEGMENTS + 1):
        need = math.ceil(k * similar)
        for same in range(min(k, depth) + 1):
            if need == k:
                continue  # equal lines only, which have their exact template
            keys = []
            for chosen in itertools.combinations(range(same, k), max(0, need - same)):
                values = [F.col("segments")[i] for i in chosen]
                at = ["leaf", F.lit(sum(1 << i for i in chosen)), *values]
                keys.append(F.struct(F.xxhash64(*at).alias("k1"), F.hash(*at).alias("k2")))
            made = F.when((F.size("segments") == k) & (F.col("same") == same), F.array(*keys)).otherwise(made)
    return made


def _first(columns: list[str], rows: DataFrame, documents: int) -> DataFrame:
    """Per template: its first (ord, tie, line), if enough different texts have it."""
    by_text = rows.groupBy(*columns, "tie").agg(F.min(F.struct("ord", "tie", "line")).alias("first"))
    found = by_text.groupBy(*columns).agg(F.count("*").alias("there"), F.min("first").alias("first"))
    return found.where(F.col("there") >= documents).drop("there")


def recurring_lines(
    docs: DataFrame,
    documents: int = 3,
    depth: int = 3,
    similar: float = 0.75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs`` and ``n_lines``, ``n_dropped``, ``kept_text``.

    Lines end at ``\\n`` only. Blank lines have no tokens, thus no template, and stay. Lines of variable
    fields alone recur only as they are. A null text has no lines and a null ``kept_text``; an empty
    text has one empty line. Copies of one text count once towards ``documents``. Rows without an id
    come last in order; repeated rows give equal rows. An empty table gives an empty result. Columns
    of ``docs`` that are called as the three new ones are replaced.
    """
    text = F.col(text_col)
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("ord"), F.xxhash64(text).alias("tie"), text.alias("body")
    )
    rows = (
        keyed.where("body is not null")
        .select("ord", "tie", F.posexplode(_lines(F.col("body"))).alias("line", "content"))
        .where(F.col("content").rlike(r"\S"))
        .withColumn("apart", _apart(F.col("content")))
        .withColumn("tokens", _tokens(F.col("apart")))
    )
    joined = F.concat_ws(" ", "tokens")
    rows = checkpointed(
        rows.select(
            "ord",
            "tie",
            "line",
            F.xxhash64(joined).alias("h1"),
            F.xxhash64(F.lit(7), joined).alias("h2"),
            F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("leaf"),
            _segments(F.col("tokens")).alias("segments"),
            _same(F.size("tokens"), depth).alias("same"),
        )
    )
    place = F.struct("ord", "tie", "line")
    # Few lines are in several texts: only those are put in order.
    by_line = checkpointed(rows.groupBy("leaf", "h1", "h2").agg(F.min("tie").alias("low"), F.max("tie").alias("high")))
    shared = small_enough(checkpointed(by_line.where("low <> high").select("h1", "h2")), 32) if documents > 1 else by_line.select("h1", "h2")
    several = checkpointed(rows.select("ord", "tie", "line", "h1", "h2").join(shared, ["h1", "h2"], "left_semi"))
    exact = small_enough(checkpointed(_first(["h1", "h2"], several, documents)), 64)
    dropped = several.join(exact, ["h1", "h2"]).where(place != F.col("first"))

    # Leaves with several lines in several texts get general templates.
    varied = (
        by_line.groupBy("leaf")
        .agg(F.count("*").alias("there"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where("there > 1 and low <> high")
        .select("leaf")
    )
    inner = checkpointed(rows.join(varied, "leaf").select("ord", "tie", "line", "leaf", "h1", "segments", "same"))
    values = inner.select("leaf", F.posexplode("segments").alias("at", "value")).groupBy("leaf", "at", "value").agg(F.count("*").alias("n"))
    usual = values.groupBy("leaf", "at").agg(F.max(F.struct("n", "value")).alias("most"))
    general = usual.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", F.col("most.value").alias("value")))).alias("general"))
    agree = F.aggregate(
        F.zip_with("segments", F.col("general.value"), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))
    )
    apart = checkpointed(inner.groupBy("leaf", "h1").agg(F.first("segments").alias("segments"), F.first("same").alias("same")))
    usual_ones = checkpointed(apart.join(general, "leaf").where(agree >= F.size("segments") * similar).select("leaf", "h1"))
    usual_least = usual_ones.groupBy("leaf").agg(F.min("h1").alias("least"))
    keyed_lines = apart.select("h1", F.explode(_keys(similar, depth)).alias("key")).select("h1", "key.k1", "key.k2")
    met = keyed_lines.groupBy("k1", "k2").agg(F.min("h1").alias("least"), F.max("h1").alias("most")).where("least <> most").drop("most")
    links = keyed_lines.join(small_enough(checkpointed(met), 32), ["k1", "k2"]).select("h1", "least")
    groups = checkpointed(components(links.union(usual_ones.join(usual_least, "leaf").select("h1", "least")).where("h1 <> least")))
    members = inner.select("ord", "tie", "line", F.col("h1").alias("node")).join(small_enough(groups, 32), "node")
    members = checkpointed(members.select("ord", "tie", "line", "component"))
    alike = members.join(_first(["component"], members, documents), "component").where(place != F.col("first"))

    gone = dropped.select("ord", "tie", "line").union(alike.select("ord", "tie", "line"))
    gone = checkpointed(gone.groupBy("ord", "tie").agg(F.collect_set("line").alias("gone")))
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept_text")]
    own = docs.select(F.struct(*[F.col(c) for c in kept]).alias("row"), *keyed_columns(id_col, text_col), text.alias("body"))
    out = own.join(small_enough(gone, 64, "4L * size(gone)"), ["ord", "tie"], "left")
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.array_except(numbers, F.coalesce("gone", F.array().cast("array<int>")))
    out = out.withColumn("lines", _lines(F.col("body"))).withColumn("left", left)
    return out.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("body"))
        .otherwise(F.array_join(F.transform("left", lambda i: F.col("lines")[i]), "\n"))
        .alias("kept_text"),
    )


def keyed_columns(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("ord"), F.xxhash64(F.col(text_col)).alias("tie")]
