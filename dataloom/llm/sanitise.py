"""Personal data by pattern, and terms that reveal it by information content.

Only DataFrame and SQL functions are used.

Base spans are four patterns (email, ip, card, phone), each matched from the
left without overlap. Every match value is a protected entity. How much a term
tells about an entity is estimated from the corpus: a term and an entity co-occur
in a document when both stand anywhere in it, and

    disclosure(t, e) = PMI(t, e) / IC(e) = log(p(t, e) / (p(t) p(e))) / -log p(e)

with document frequencies over all documents. 1 means that the term stands only
where the entity does. Terms of at least ``threshold`` that are seen with the
entity in at least ``support`` documents are spans of kind ``term`` wherever they
stand in a document that holds the entity.

As n_both <= n(e), a term can only reach the threshold when n(t) is at most
n(e)^threshold * N^(1 - threshold). Terms meet the entities of their document
only below this bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import materialize, named, prepare

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. Quantifiers are possessive and a match starts at the head of a
# run (or where the last match ended): the same matches as the plain patterns,
# found without backtracking, so a text of one long run costs no more.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",  # shorter runs would be dropped
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_WORD = r"\p{L}[\p{L}\p{N}'_-]*+"


_SPANS = "array<struct<s:int,e:int,m:string>>"


def _let(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), made)[0]


def _blocks(values: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of each block of about sqrt(n) of the n values, in order.

    A list that grows by one value at a time is copied at every step, so long
    lists are grown in blocks: n^1.5 copied values in place of n^2.
    """
    size = F.ceil(F.sqrt(F.size(values))).cast("int")
    starts = F.sequence(F.lit(1), F.size(values), size)
    return F.when(F.size(values) > 0, F.transform(starts, lambda k: made(F.slice(values, k, size)))).otherwise(
        F.transform(F.array().cast("array<int>"), lambda k: made(values)))


def _placed(pairs: Column, keep: Callable[[Column], Column], shown: Callable[[Column], Column]) -> Column:
    """array<struct<s, e, m>> of the matches that ``keep``; ``pairs`` are matches m with the length ``gap`` of what stands before each."""

    def block(part: Column) -> Column:
        return F.aggregate(
            part, F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")),
            lambda acc, p: F.struct(
                (acc["at"] + p["gap"] + F.length(p["m"])).alias("at"),
                F.when(keep(p["m"]), F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + p["gap"]).alias("s"), (acc["at"] + p["gap"] + F.length(p["m"])).alias("e"), shown(p["m"]).alias("m")))))
                .otherwise(acc["out"]).alias("out")))

    def moved(blocks: Column) -> Column:
        starts = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                             lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(blocks, starts, lambda x, by: F.transform(
            x["out"], lambda w: F.struct((w["s"] + by).alias("s"), (w["e"] + by).alias("e"), w["m"].alias("m")))))

    return _let(F.filter(pairs, lambda p: p["m"].isNotNull()), lambda rows: _let(_blocks(rows, block), moved))


def _matches(text: Column, pattern: str) -> Column:
    """Matches with the gaps before them: there is one gap more, behind the last match."""
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.transform(F.split(text, pattern, -1), F.length).alias("gap"))


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>> of the matches, code points."""
    return F.when(text.rlike(pattern), _placed(_matches(text, pattern), lambda m: F.lit(True), lambda m: m)).otherwise(F.array().cast(_SPANS))


def _each(kind: str, made: Callable[[Column, str], Column]) -> Column:
    """The spans in column ``kind``, each turned into ``made(span, kind)``."""
    return F.transform(kind, lambda x: made(x, kind))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"))
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "card":
        backwards = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, F.try_to_number(d, F.lit("9")) * 2).otherwise(F.try_to_number(d, F.lit("9"))).cast("int"))
        luhn = F.aggregate(backwards, F.lit(0), lambda a, d: a + F.when(d.isNull(), 0).when(d > 9, d - 9).otherwise(d))
        return F.when(F.length(digits).between(13, 19), luhn % 10 == 0).otherwise(False)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    hint = _HINT[kind]
    found = F.filter(_spans(text, PATTERNS[kind]), lambda x: _valid(kind, x["m"]))
    empty = F.array().cast(_SPANS)
    return F.when(text.contains(hint), found).otherwise(empty) if hint else found


def _words(text: Column) -> Column:
    """The different words of a text in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def _told_spans(text: Column, told: Column) -> Column:
    """array<struct<s, e, m>> of every word of the text that is in ``told``; other words only move the position."""
    return _placed(_matches(text, _WORD), lambda m: F.array_contains(told, F.lower(m)), F.lower)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
         support: int = 3, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: doc_id, text, email, ip, card, phone, term (arrays of s, e, m), rest.

    Offsets are code points of the whole text, end exclusive. Null text is
    empty text. Repeated rows stay and count once per row as documents; rows
    with equal or null ids are still separate documents of equal text or not.
    An empty table gives no rows. ``rest`` is a struct of the ``carry`` columns;
    columns not named are not read.
    """
    prepare(df.sparkSession)
    rest = F.struct(*[named(c) for c in carry]) if carry else F.lit(None).cast("string")
    docs = df.select(F.col(id_col).alias("did"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), rest.alias("rest"))
    total = max(2, docs.count())
    marked = docs.select("did", "text", "rest", *[base_spans(F.col("text"), k).alias(k) for k in KINDS])

    # a document is told by its id and text; rows with an entity are written once, with their words
    every = F.concat(*[_each(k, lambda x, kind: F.concat(F.lit(f"{kind}:"), F.lower(x["m"]))) for k in KINDS])
    rows = marked.select(F.xxhash64("did", "text").alias("doc"), F.array_distinct(every).alias("entities"), "text").where(F.size("entities") > 0)
    rows = materialize(rows.select("doc", "entities", _words(F.col("text")).alias("words")), "private-documents")
    entities = rows.select("doc", F.explode("entities").alias("entity"))
    df_entity = entities.groupBy("entity").agg(F.count("*").alias("n_entity")).where((F.col("n_entity") >= support) & (F.col("n_entity") < total))
    # frequent entities, once per document however often its row stands; the words keep the rows
    held = materialize(entities.distinct().join(df_entity, "entity"), "private-entities")
    top = held.agg(F.max("n_entity")).first()[0] or 0
    most = lambda n: F.pow(n, F.lit(threshold)) * F.lit(float(total) ** (1 - threshold) * (1 + 1e-9))
    df_term = docs.select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    df_term = df_term.where((F.col("n_term") >= support) & (F.col("n_term") <= most(F.lit(top))))
    around = rows.join(held.select("doc").distinct(), "doc", "left_semi").select("doc", F.explode("words").alias("term")).join(df_term, "term")
    pairs = materialize(around.join(held, "doc").where(F.col("n_term") <= most(F.col("n_entity"))), "private-pairs")
    told = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity"))
    ratio = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity"))) / F.log(F.lit(float(total)) / F.col("n_entity"))
    told = told.where((F.col("n_both") >= support) & (ratio >= threshold)).select("entity", "term")
    terms = pairs.join(told, ["entity", "term"], "left_semi").groupBy("doc").agg(F.collect_set("term").alias("told"))

    keyed = marked.withColumn("key", F.xxhash64("did", "text"))
    inside = lambda w: ~F.exists(F.concat(*KINDS), lambda x: (x["s"] < w["e"]) & (w["s"] < x["e"]))
    none = F.array().cast(_SPANS)
    out = keyed.join(terms, keyed.key == terms.doc, "left")
    term = F.when(F.col("told").isNull(), none).otherwise(F.array_sort(F.filter(_told_spans(F.col("text"), F.col("told")), inside)))
    return out.select(F.col("did").alias("doc_id"), "text", *KINDS, term.alias("term"), "rest")


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans, by kind as given, then start, joined by commas."""
    return F.array_join(F.concat(*[_each(k, lambda x, kind: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))) for k in kinds]), ",")


def clean(found: DataFrame) -> DataFrame:
    """``found`` with ``text`` sanitised: base values are removed behind their kind in capitals, terms generalised to <TERM>.

    Of overlapping spans the first to start (then the longest) names the whole run.
    """
    kinds = (*KINDS, "term")
    every = F.array_sort(F.concat(*[_each(k, lambda x, kind: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), F.lit(f"<{kind.upper()}>").alias("m"))) for k in kinds]))
    text = F.col("text")

    def block(part: Column, begin: Column, piece: Column) -> Column:
        """The spans' marks and what stands before each of them, from ``begin`` on."""
        return F.aggregate(
            part, F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out")),
            lambda acc, x: F.when(x["s"] >= acc["at"], F.struct(
                (-x["e"]).alias("at"), F.concat(acc["out"], F.array(F.substring(piece, acc["at"] - begin + 1, x["s"] - acc["at"]), x["m"])).alias("out")))
            .otherwise(F.struct(F.greatest(acc["at"], -x["e"]).alias("at"), acc["out"].alias("out"))),
            lambda acc: F.array_join(acc["out"], ""))

    def rebuilt(parts: Column) -> Column:
        # where each block begins: behind all spans of those before it
        ends = F.transform(parts, lambda p: F.array_max(F.transform(p, lambda x: -x["e"])))
        begin = F.aggregate(ends, F.array(F.lit(0)), lambda acc, e: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), e))))
        return _let(begin, lambda b: F.concat(
            F.array_join(F.transform(parts, lambda p, i: _let(
                F.substring(text, F.get(b, i) + 1, F.get(b, i + 1) - F.get(b, i)), lambda piece: block(p, F.get(b, i), piece))), ""),
            F.substring(text, F.element_at(b, -1) + 1, F.length(text))))

    done = _let(every, lambda spans: _let(_blocks(spans, lambda part: part), rebuilt))
    return found.withColumn("text", F.when(F.size(every) > 0, done).otherwise(text))
