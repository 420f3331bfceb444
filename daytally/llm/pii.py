"""Personal data: spans of fixed kinds, and terms that give them away.

A protected value that the corpus repeats may be told from the words of its documents. How
much a term reveals of a value is their pointwise mutual information over the corpus, in
whole documents, as a share of the information in the value itself: 1 if the term occurs in
documents with that value alone. Terms above a threshold are generalised, and above a higher
one removed, wherever they stand in a document with the value.

Everything is DataFrame functions: a text is split at the matches of a pattern, and the
lengths of the pieces give the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import maybe_in, text_or_empty, written

#: The kinds and their order. Possessive parts and the look behind change no
#: match (what they skip cannot match from a later place); they keep long runs linear.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = "term"
TERM_PATTERN = r"\p{L}{3,}"
#: Documents with a value in which a term must stand, where those with the same characters
#: on either side of the value count as copies of one document.
SUPPORT = 2
SURROUNDING = 64
GENERALISE, REMOVE = 0.75, 0.95


def _pieces(text: Column, pattern: str) -> Column:
    """The text between matches and the matches, in turn; the last has no match."""
    zipped = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return zipped.cast("array<struct<gap:string,found:string>>")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of up to 19 digits passes the check."""
    backwards = F.reverse(digits)
    worth = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.when(i % 2 == 1, F.substring(backwards, i, F.lit(1)).cast("int")).otherwise(
            F.substring(backwards, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(backwards, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: Column, found: Column) -> Column:
    n = F.length(_digits(found))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", found.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"))
        .when(kind == "card", F.when(n.between(13, 19), luhn(_digits(found))).otherwise(False))
        .otherwise(n.between(9, 15))
    )


def keyed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, h, text): a document is its key and a hash of its text; equal rows are one."""
    whole = text_or_empty(text)
    return docs.select(F.col(key).alias("id"), F.xxhash64(whole).alias("h"), whole.alias("text"))


def base_spans(rows: DataFrame) -> DataFrame:
    """(id, h, kind, start, end, found, context): valid matches and a hash of what surrounds them."""
    may = {"email": F.instr("text", "@") > 0, "phone": F.instr("text", "+") > 0}
    kinds = F.array(
        *(
            F.struct(
                F.lit(k).alias("kind"),
                F.when(may[k], _pieces(F.col("text"), PATTERNS[k])).alias("pieces") if k in may else _pieces(F.col("text"), PATTERNS[k]).alias("pieces"),
            )
            for k in KINDS
        )
    )
    each = rows.select("id", "h", F.explode(kinds).alias("of")).filter(F.size("of.pieces") > 1)
    pieces = each.select("id", "h", F.col("of.kind").alias("kind"), F.posexplode("of.pieces").alias("pos", "piece"))
    pieces = pieces.select(
        "id", "h", "kind", "pos",
        F.length("piece.gap").alias("gap"), F.col("piece.found").alias("found"),
        F.right("piece.gap", F.lit(SURROUNDING)).alias("left"), F.left("piece.gap", F.lit(SURROUNDING)).alias("next"),
    ).repartition("id", "h", "kind").distinct()
    place = Window.partitionBy("id", "h", "kind").orderBy("pos")
    end = F.sum(F.col("gap") + F.coalesce(F.length("found"), F.lit(0))).over(place)
    placed = pieces.select("*", end.alias("end"), F.lead("next").over(place).alias("right")).filter("found IS NOT NULL")
    placed = placed.filter(_holds(F.col("kind"), F.col("found")))
    return placed.select("id", "h", "kind", (F.col("end") - F.length("found")).cast("long").alias("start"), F.col("end").cast("long").alias("end"), "found", F.xxhash64("left", "right").alias("context"))


def _value(kind: Column, found: Column) -> Column:
    """A protected value however it is written."""
    return F.concat(kind, F.lit(":"), F.when(kind.isin("email", "ip"), F.lower(found)).otherwise(_digits(found)))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0)))


def disclosing(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(value, term, share): terms in documents with a value, at least SUPPORT of them no
    copies, that reveal at least GENERALISE of it. All counts are of whole documents."""
    held = spans.groupBy(_value(F.col("kind"), F.col("found")).alias("value"), "id", "h").agg(F.min("context").alias("context"))
    # Equal texts have equal terms: their terms are taken once, for all values that they hold.
    held = held.groupBy("value", "h").agg(F.count(F.lit(1)).alias("copies"), F.min("context").alias("context"))
    values = held.groupBy("value").agg(F.sum("copies").alias("n_value"), F.count_distinct("context").alias("support"))
    values = written(values.filter(F.col("support") >= SUPPORT).select("value", "n_value"), "values")
    several = written(held.join(values.select("value"), "value"), "held")

    texts = maybe_in(rows.select("h", "text"), "h", several.select("h"), "h").select("h", _terms(F.col("text")).alias("terms"))
    texts = texts.join(several.select("h").distinct(), "h", "left_semi").dropDuplicates(["h"])
    together = texts.join(several, "h").select("value", "copies", "context", F.explode("terms").alias("term"))
    by_context = together.groupBy("value", "term", "context").agg(F.sum("copies").alias("n"))
    pairs = by_context.groupBy("value", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("support"))
    pairs = written(pairs.filter(F.col("support") >= SUPPORT).select("value", "term", "n_both"), "pairs")

    counted = maybe_in(rows.select(F.explode(_terms(F.col("text"))).alias("term")), "term", pairs.select("term").distinct(), "term")
    n_term = counted.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n = max(1, rows.count())
    known = pairs.join(n_term, "term").join(values, "value")
    mutual = F.log(F.col("n_both") * F.lit(float(n)) / (F.col("n_term") * F.col("n_value")))
    whole = F.log(F.lit(float(n)) / F.col("n_value"))
    share = F.when(whole > 0, mutual / whole).otherwise(F.lit(0.0))
    return known.select("value", "term", share.alias("share")).filter(F.col("share") >= GENERALISE)


def _places(rows: DataFrame, base: DataFrame, told: DataFrame) -> DataFrame:
    """(id, h, start, end, share): each place of a disclosing term in the documents that hold
    a value it discloses."""
    held = base.select(_value(F.col("kind"), F.col("found")).alias("value"), "id", "h").distinct()
    wanted = written(held.join(told, "value").groupBy("id", "h", "term").agg(F.max("share").alias("share")), "wanted")
    texts = maybe_in(rows, "h", wanted.select("h").distinct(), "h").distinct()
    pieces = texts.select("id", "h", F.posexplode(_pieces(F.col("text"), TERM_PATTERN)).alias("pos", "piece"))
    place = Window.partitionBy("id", "h").orderBy("pos")
    end = F.sum(F.length("piece.gap") + F.coalesce(F.length("piece.found"), F.lit(0))).over(place).cast("long")
    placed = pieces.select("id", "h", F.col("piece.found").alias("found"), end.alias("end")).filter("found IS NOT NULL")
    placed = placed.select("id", "h", F.lower("found").alias("term"), (F.col("end") - F.length("found")).alias("start"), "end")
    theirs = wanted.select(F.col("id").alias("of"), F.col("h").alias("hash"), F.col("term").alias("told"), "share")
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("hash")) & (F.col("term") == F.col("told"))
    return placed.join(theirs, same).select("id", "h", "start", "end", "share")


def all_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, h, kind, start, end, share): base spans, then disclosing terms, each once.
    ``start`` and ``end`` count code points from 0; ``share`` is null for base spans."""
    rows = keyed(docs, text, key)
    base = written(base_spans(rows), "spans")
    told = written(disclosing(rows, base), "disclosing")
    more = _places(rows, base, told).select("id", "h", F.lit(TERM).alias("kind"), "start", "end", "share")
    return base.select("id", "h", "kind", "start", "end", F.lit(None).cast("double").alias("share")).unionByName(more)


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, (*KINDS, TERM))), kind)


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, spans) for every row: an array of (rank, start, end, kind, share), by kind in
    the order of KINDS, terms last, then start.

    A null text is empty and has no spans, nor has an empty one; a text of any length is
    searched whole, and terms anywhere in it count. Null keys pass; equal rows have equal
    spans, and rows that share only the key are told apart by their texts; an empty table
    gives an empty result; other columns do not pass.
    """
    listed = all_spans(docs, text, key).withColumn("span", F.struct(_order(F.col("kind")).alias("rank"), "start", "end", "kind", "share"))
    lists = listed.groupBy("id", "h").agg(F.sort_array(F.collect_set("span")).alias("spans"))
    lists = lists.select(F.col("id").alias("of"), F.col("h").alias("hash"), "spans")
    rows = keyed(docs, text, key).select("id", "h")
    joined = rows.join(lists, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("hash")), "left")
    empty = F.array().cast(lists.schema["spans"].dataType)
    return joined.select(F.col("id").alias(key), F.coalesce("spans", empty).alias("spans"))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with base spans replaced by their kind in brackets, and disclosing terms by
    ``[TERM]`` or, from REMOVE on, by nothing. Where spans overlap, the first one counts,
    and of those that start together the longest. Rows without spans, null and empty texts
    pass as they are, with all their columns, whatever these are called; equal rows stay
    equal; texts of any length are sanitised whole; an empty table gives an empty result."""
    listed = all_spans(docs, text, key).groupBy("id", "h").agg(F.sort_array(F.collect_set(F.struct("start", (-F.col("end")).alias("to"), "kind", "share"))).alias("spans"))
    lists = listed.select(F.col("id").alias("of"), F.col("h").alias("hash"), "spans")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(key).alias("id"), text_or_empty(text).alias("text"))
    joined = packed.join(lists, F.col("id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("hash")), "left")
    label = lambda s: F.when(s["share"] >= REMOVE, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def replace(so_far: Column, s: Column) -> Column:
        piece = F.substring(F.col("text"), (so_far["at"] + 1).cast("int"), (s["start"] - so_far["at"]).cast("int"))
        new = F.struct((-s["to"]).alias("at"), F.concat(so_far["out"], piece, label(s)).alias("out"))
        return F.when(s["start"] >= so_far["at"], new).otherwise(so_far)

    rest = lambda x: F.concat(x["out"], F.substring(F.col("text"), (x["at"] + 1).cast("int"), F.length("text")))
    clean = F.when(F.col("spans").isNull(), F.col(f"row.`{text}`")).otherwise(F.aggregate("spans", zero, replace, rest))
    return joined.select(*(clean.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
