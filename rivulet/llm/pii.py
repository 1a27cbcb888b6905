"""Personal data: entities by pattern, and terms that give entities away by co-occurrence; SQL functions only.

After finding e-mail addresses, IP addresses, card and phone numbers, the corpus tells which other words
reveal them. Evidence is counted in distinct texts: N of them, n_t with the word, n_e with the entity, n_et with both.
A word discloses the entity as far as a text with the word has the entity too: the chance n_et / n_t, of which the lower end of a
one-sided 95 % interval (Wilson's) counts, so that few texts prove little, however large the corpus is; at least ``MIN_SUPPORT`` texts
must have both. And it must tell more than the corpus at large: log2(chance * N / n_e) is at least ``BITS``.
Words from ``GENERALISE`` on are generalised where the entity occurs, and removed from ``REMOVE`` on.
Besides the exact value, an entity stands for its class: the domain of an address, the prefix of a number. (The
kind is no class: the mark that replaces the entity tells it.) So classes carry the evidence where no value stands in several texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import doc_key, read, staged, text_of

# Possessive forms of the patterns: no backtracking, the same matches. A run of address characters is tried at its start only.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
WORD = r"[\p{L}\p{N}]+"
MIN_SUPPORT, GENERALISE, REMOVE, BITS = 3, 0.5, 0.9, 1.0
_Z2 = 1.6448536269514722**2
SPANS = "array<struct<start:int,kind:int,end:int,found:string>>"


def matches(text: Column, pattern: Column, kind: str) -> Column:
    """Leftmost matches without overlap: start, kind, end (code points, end exclusive) and the string found.

    Places come from the lengths of what lies between the matches.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m, i: F.struct(m.alias("m"), F.get(gaps, i).alias("gap")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        end = begin + F.length(p["m"])
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), p["m"].alias("found"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(found)).between(12, 19) & _luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda s: _valid(kind, s["found"])


def _is(number: int):
    return lambda s: s["kind"] == number


def base_spans(text: Column) -> Column:
    """All valid entities of a text, by start, then kind."""
    parts = []
    for kind, pattern in PATTERNS.items():
        hint = {"email": "@", "phone": "+"}.get(kind)
        found = F.filter(matches(text, F.lit(pattern), kind), _check(kind))
        none = F.array().cast(SPANS)
        parts.append(F.when(F.contains(text, F.lit(hint)), found).otherwise(none) if hint else found)
    return F.array_sort(F.concat(*parts))


def _entity(s: Column) -> Column:
    """What a span stands for: addresses in lower case, numbers without their separators."""
    name = F.get(F.array(*map(F.lit, KINDS)), s["kind"])
    value = F.when(name.isin("card", "phone"), _digits(s["found"])).otherwise(F.lower(s["found"]))
    return F.concat_ws(":", name, value)


def _stands_for(s: Column) -> Column:
    """The entity of a span and its class: e-mail domain, first three parts of an IP address, issuer digits of a card, phone number without the last four digits."""
    name, digits = F.get(F.array(*map(F.lit, KINDS)), s["kind"]), _digits(s["found"])
    part = F.when(name == "email", F.substring_index(F.lower(s["found"]), "@", -1)).when(name == "ip", F.substring_index(s["found"], ".", 3))
    part = part.when(name == "card", F.substr(digits, F.lit(1), F.lit(6))).otherwise(F.substr(digits, F.lit(1), F.length(digits) - 4))
    return F.array(_entity(s), F.concat_ws("/", name, part))


def words_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _hashed_words(text: Column) -> Column:
    return F.transform(words_of(text), lambda x: F.xxhash64(x))


def least_chance(hits: Column, n: Column) -> Column:
    """The lower end of Wilson's one-sided 95 % interval for a chance seen ``hits`` times in ``n``."""
    rate, n = hits / n, n.cast("double")
    spread = F.sqrt(_Z2 * (rate * (1 - rate) / n + _Z2 / (4 * n * n)))
    return (rate + _Z2 / (2 * n) - spread) / (1 + _Z2 / n)


def disclosing_terms(found: DataFrame, docs: DataFrame, text_col: str, min_support: int, generalise: float) -> DataFrame:
    """``entity word share`` of the words (by hash) that reveal an entity or class; counts are of distinct texts of the whole corpus.

    Every word of a text with the entity is a candidate, once per text, but for those that stand only in the entities
    themselves. Values that too few texts have are left out before their words are written out.
    """
    beside = found.where(F.size("base") > 0).dropDuplicates(["hash"])
    outside = F.aggregate("base", F.col("text"), lambda acc, s: F.replace(acc, s["found"], F.lit(" ")))
    entities = F.array_distinct(F.flatten(F.transform("base", _stands_for)))
    beside = beside.select(F.explode(entities).alias("entity"), _hashed_words(outside).alias("words"))
    # What half of all texts have can't be told by a word.
    texts = docs.select(F.xxhash64(text_of(text_col)).alias("hash"), text_of(text_col).alias("text"))
    total = texts.agg(F.count_distinct("hash")).scalar()
    seen = beside.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= min_support)
    seen = seen.withColumn("of", total).where(F.col("n_e") * 2.0**BITS <= F.col("of"))
    pairs = beside.join(seen, "entity").select("entity", "n_e", "of", F.explode("words").alias("word"))
    pairs = pairs.groupBy("entity", "n_e", "of", "word").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= min_support)
    # The share is greatest where the word stands nowhere else: pairs that fail even then need no count.
    pairs = pairs.where(least_chance(F.col("n_et"), F.col("n_et")) >= generalise)
    # A word is counted once per text; counts are summed in each input split before they are shuffled.
    once = texts.dropDuplicates(["hash"])  # copies leave each input split once
    counts = once.select(F.explode(_hashed_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n_t"))
    scored = pairs.join(counts, "word").withColumn("share", least_chance(F.col("n_et"), F.col("n_t")))
    told = F.log2(F.col("share") * F.col("of") / F.col("n_e")) >= BITS
    return scored.where((F.col("share") >= generalise) & told).select("entity", "word", "share")


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_support: int = MIN_SUPPORT,
    generalise: float = GENERALISE,
) -> DataFrame:
    """One row per document: ``doc_id key hash base extra strong_terms``; base and extra are lists of spans (start, kind, end, found).

    ``base`` holds e-mail addresses, IP addresses (parts up to 255), card numbers (12 to 19 digits that pass the
    Luhn check) and phone numbers (9 to 15 digits); ``extra`` the occurrences of terms that disclose an
    entity of the document or its class, ``strong_terms`` those of them that disclose nearly all. A term needs
    ``min_support`` different texts that have it and the entity. Null texts are empty; null ids stay null; repeated rows are treated alike and copies of a text count once; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), doc_key(id_col, text_col).alias("key"), F.xxhash64(text_of(text_col)).alias("hash"), text_of(text_col).alias("text")
    )
    rows = rows.withColumn("base", base_spans(F.col("text")))
    # Texts without an entity are not needed any more.
    found = staged(rows.withColumn("text", F.when(F.size("base") > 0, F.col("text"))))
    terms = disclosing_terms(found, docs, text_col, min_support, generalise)
    having = found.where(F.size("base") > 0)
    told = having.select("key", "hash", F.explode(F.array_distinct(F.flatten(F.transform("base", _stands_for)))).alias("entity")).distinct()
    # Words meet terms first: few entities have a term, while a class may have many terms that most of its texts lack.
    own_words = having.select("key", "hash", F.explode(words_of(F.col("text"))).alias("term")).distinct().withColumn("word", F.xxhash64("term"))
    told = own_words.join(terms, "word").join(told, ["key", "hash", "entity"])
    told = told.groupBy("key", "hash", "term").agg(F.max("share").alias("share"))
    told = told.groupBy("key", "hash").agg(F.collect_list(F.struct("term", "share")).alias("terms"))
    out = found.join(told, ["key", "hash"], "left")
    own = F.transform("terms", lambda t: t["term"])
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(own, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    extra = F.filter(matches(F.col("text"), pattern, "term"), lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    out = out.withColumn("extra", F.when(F.size(own) > 0, extra).otherwise(F.array().cast(SPANS)))
    strong = F.transform(F.filter("terms", lambda t: t["share"] >= REMOVE), lambda t: t["term"])
    return out.select("doc_id", "key", "hash", "base", "extra", F.coalesce(strong, F.array().cast("array<string>")).alias("strong_terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """All rows of ``docs`` with entities replaced by ``[KIND]``, weakly disclosing terms by ``[TERM]``, strongly disclosing ones removed."""
    found = find_personal_data(docs, id_col, text_col, **how).where("size(base) > 0")
    found = found.groupBy("key", "hash").agg(F.first("base").alias("_base"), F.first("extra").alias("_extra"), F.first("strong_terms").alias("_strong"))
    found = found.withColumnsRenamed({"key": "_key", "hash": "_hash"})
    same = (F.col("_key") == doc_key(id_col, text_col)) & (F.col("_hash") == F.xxhash64(text_of(text_col)))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        drop = (s["kind"] == KINDS.index("term")) & F.array_contains("_strong", F.lower(s["found"]))
        piece = F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.when(drop, "").otherwise(F.get(marks, s["kind"])))
        done = F.struct(s["end"].alias("at"), F.concat(acc["out"], piece).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], done).otherwise(longer)  # overlapping spans become one

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(F.array_sort(F.concat("_base", "_extra")), start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))
    joined = docs.join(found, same, "left")
    return joined.withColumn(text_col, F.when(F.col("_base").isNull(), text).otherwise(rest)).drop("_base", "_extra", "_strong", "_key", "_hash")


def _told(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(PATTERNS)]
    base = _told(F.col("base"))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        _told(F.array_sort(F.concat("base", "extra"))).alias("spans"),
        F.size("extra").cast("long").alias("n_terms"),
    )
