"""Line dedup by winnowing: fingerprints of line runs, matched by position, extended, later copies deleted; SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import doc_key, read, staged, text_of

MIN_WORDS = 8
CHARS = 10  # so many characters without a blank count as a word
SEGMENT = 512
_BLANKS = " \t\r\v\f"


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body or lambdas in it use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(text: Column) -> Column:
    """Lines that are not blank: hash of the line without blanks around it, place, number of words."""
    trimmed = F.transform(_lines(text), lambda x: F.trim(x, F.lit(_BLANKS)))
    blanks = lambda x: F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit("")))
    lines = F.transform(
        trimmed,
        lambda x, i: F.struct(
            F.xxhash64(x).alias("h"),
            i.alias("at"),
            (x != "").alias("on"),
            F.greatest(blanks(x) + 1, F.floor(F.length(x) / F.lit(CHARS)).cast("int")).alias("w"),
        ),
    )
    return F.filter(lines, lambda x: x["on"])


def _windows(lines: str, min_words: int) -> Column:
    """The shortest run of at least ``min_words`` words that begins at each line, and the shortest that ends there.

    Of each its hash, its first line, its least line (hash and place) and its length. Any longer run is a union of these.
    """
    line = F.col(lines)

    def reach(near: Column) -> Column:
        """How many of the lines make enough words; null if all don't."""
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"))
        more = lambda acc, x: F.when(acc["w"] >= min_words, acc).otherwise(F.struct((acc["n"] + 1).alias("n"), (acc["w"] + x["w"]).alias("w")))
        return F.aggregate(near, start, more, lambda acc: F.when(acc["w"] >= min_words, acc["n"]))

    def run(i: Column, n: Column) -> Column:
        held = F.slice(line, i + 1, n)
        least = F.array_min(F.transform(held, lambda x: F.struct(x["h"].alias("h"), x["at"].alias("at"))))
        return F.struct(F.xxhash64(F.transform(held, lambda x: x["h"])).alias("key"), i.alias("i"), least.alias("least"), n.alias("n"))

    def alone(x: Column, i: Column) -> Column:
        least = F.struct(x["h"].alias("h"), x["at"].alias("at"))
        return F.struct(F.xxhash64(F.array(x["h"])).alias("key"), i.alias("i"), least.alias("least"), F.lit(1).alias("n"))

    def ahead(x: Column, i: Column) -> Column:
        short = _let(reach(F.slice(line, i + 1, min_words)), lambda n: F.when(n.isNotNull(), run(i, n)))
        return F.when(x["w"] >= min_words, alone(x, i)).otherwise(short)

    def behind(x: Column, i: Column) -> Column:
        near = F.reverse(F.slice(line, F.greatest(i - min_words + 2, F.lit(1)), F.least(i + 1, F.lit(min_words))))
        return F.when(x["w"] < min_words, _let(reach(near), lambda n: F.when(n.isNotNull(), run(i - n + 1, n))))

    return F.filter(F.concat(F.transform(line, ahead), F.transform(line, behind)), lambda x: x.isNotNull())


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with later copies of line runs: ``key hash gone``, the places of the lines to delete.

    Winnowing keeps the least line of every window as a fingerprint, a window being the shortest run of enough words from a
    line on, or up to it; so any run of enough words that stands in two places leaves an equal fingerprint in both.
    Fingerprints found once end there. From the others the match is extended line by line both ways, by comparing the windows
    that hold the fingerprint as their least line; those found at an earlier place mark their lines. A longer run is the union of its
    windows, so all of its lines go. A long text is dealt in segments of windows: its work grows as its lines do.
    """
    rows = docs.select(
        doc_key(id_col, text_col).alias("key"), F.xxhash64(text_of(text_col)).alias("hash"), text_of(text_col).alias("text")
    )
    rows = rows.withColumn("lines", _filled(F.col("text"))).withColumn("windows", _windows("lines", min_words))
    starts = F.when(F.size("windows") > 0, F.sequence(F.lit(1), F.size("windows"), F.lit(SEGMENT)))
    segments = F.transform(starts, lambda k: F.struct(k.alias("segment"), F.slice("windows", k, SEGMENT).alias("windows")))
    # Much smaller than the texts, which are read once for it.
    rows = staged(rows.select("key", "hash", F.explode(segments).alias("s")).select("key", "hash", "s.segment", "s.windows"))
    prints = F.array_distinct(F.transform("windows", lambda x: x["least"]))
    spread = rows.select("key", "hash", "segment", F.explode(prints).alias("p")).select("key", "hash", "segment", F.col("p.h").alias("h"), F.col("p.at").alias("at"))
    place = F.struct("key", "hash", "at")
    found = spread.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("h")
    anchors = spread.select("key", "hash", "segment", "h").distinct().join(found, "h")
    anchors = anchors.groupBy("key", "hash", "segment").agg(F.collect_set("h").alias("hs"))  # of one segment: 512 at most
    near = rows.join(anchors, ["key", "hash", "segment"])
    near = near.select("key", "hash", F.explode(F.filter("windows", lambda x: F.array_contains("hs", x["least"]["h"]))).alias("w"))
    near = staged(near.select("key", "hash", F.col("w.key").alias("run"), F.col("w.i").alias("i"), F.col("w.n").alias("n")))
    spot = F.struct("key", "hash", "i")
    firsts = near.groupBy("run").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first < last")
    # Stored, so that both sides of the join are dealt for it and Spark may split a run that very many texts have.
    later = near.join(staged(firsts.select("run", "first")), "run").where(spot > F.col("first"))
    marks = later.select("key", "hash", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("n") - 1)).alias("i")).distinct()
    return marks.groupBy("key", "hash").agg(F.collect_list("i").alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with the text's repeated line runs deleted, plus ``n_lines`` and ``n_deleted``.

    Deleted is every line in a run of lines, one or more, with at least ``min_words`` words that also
    stands at an earlier place: in a document with a smaller id, or before in the same one. Words are parted by blanks; in
    scripts that have none, ten characters count as one. Blank lines are
    neither counted nor matched and stay; blanks around a line are ignored. So of a line that
    is repeated over and over, one copy stays. All is judged on the input.

    Null texts stay null and have no lines; rows without id come last, keyed by their text;
    rows equal in id and text are one document and are treated alike; texts of other rows with the same
    id are ordered by a hash. An empty table gives no rows; columns named like the results are replaced.
    """
    docs = docs.drop("n_lines", "n_deleted")
    # Both readings of the texts are dealt alike, by the document.
    gone = repeated_runs(docs, min_words, id_col, text_col).select(F.col("key").alias("_key"), F.col("hash").alias("_hash"), F.col("gone").alias("_gone"))
    marked = docs.withColumns({"_own": doc_key(id_col, text_col), "_text": F.xxhash64(text_of(text_col))})
    joined = marked.join(gone, (F.col("_own") == F.col("_key")) & (F.col("_text") == F.col("_hash")), "left")

    def kept(s: Column) -> Column:
        """The stretches of lines between those that go."""
        at = F.array_sort(F.transform(s["gone"], lambda i: F.get(s["filled"], i)["at"]))
        edges = F.concat(F.array(F.lit(-1)), at, F.array(F.size(s["lines"])))
        gaps = F.sequence(F.lit(0), F.size(s["gone"]))
        return _let(edges, lambda e: F.flatten(F.transform(gaps, lambda k: F.slice(s["lines"], F.get(e, k) + 2, F.get(e, k + 1) - F.get(e, k) - 1))))

    parts = F.struct(F.col("_gone").alias("gone"), _filled(F.col(text_col)).alias("filled"), _lines(F.col(text_col)).alias("lines"))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(_let(parts, kept), "\n"))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.regexp_count(F.col(text_col), F.lit(r"(?md)^[^\n]*[^ \t\r\x0B\f\n]")))
    n_lines = n_lines.cast("long")
    out = joined.withColumns({"n_lines": n_lines, "n_deleted": F.coalesce(F.size("_gone"), F.lit(0)).cast("long")})
    out = out.withColumn("n_deleted", F.when(F.col("_gone").isNull(), 0).otherwise(F.col("n_deleted")).cast("long"))
    return out.withColumn(text_col, text).drop("_key", "_hash", "_gone", "_own", "_text")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line runs that earlier places have."""
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_deleted", "text")


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, i - 1 AS pos, line, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS k,
         greatest(length(t) - length(replace(t, ' ', '')) + 1, length(t) // {CHARS}) AS w
  FROM lines WHERE t <> ''
), near AS (
  SELECT doc_id, k, list(t) OVER a AS ta, list(w) OVER a AS wa, list(t) OVER b AS tb, list(w) OVER b AS wb FROM filled
  WINDOW a AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING),
         b AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)
), reach AS (
  SELECT *, list_filter(range(1, len(wa) + 1), lambda n: list_sum(wa[1:n]) >= {MIN_WORDS})[1] AS na,
         list_filter(range(1, len(wb) + 1), lambda n: list_sum(wb[len(wb) - n + 1:len(wb)]) >= {MIN_WORDS})[1] AS nb FROM near
), win AS (
  SELECT DISTINCT doc_id, k, na AS n, ta[1:na] AS run FROM reach WHERE na IS NOT NULL
  UNION SELECT doc_id, k - nb + 1, nb, tb[len(tb) - nb + 1:len(tb)] FROM reach WHERE nb IS NOT NULL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS k FROM ranked WHERE r > 1)
SELECT lines.doc_id, count(filled.k)::BIGINT AS n_lines, count(gone.k)::BIGINT AS n_deleted,
       coalesce(string_agg(lines.line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.k IS NULL), '') AS text
FROM lines LEFT JOIN filled ON lines.doc_id = filled.doc_id AND lines.pos = filled.pos
     LEFT JOIN gone ON filled.doc_id = gone.doc_id AND filled.k = gone.k
GROUP BY lines.doc_id
"""
