"""Personal data: spans of fixed kinds, and terms that disclose them.

Built-in functions only. The base finds e-mail addresses, IP addresses, card and phone numbers.
A match's place is found by cutting the text at all matches of a kind and adding up lengths.

The method then looks for terms that give a protected entity away although they are no
personal data themselves. A protected entity is the value of a base span. For a term t and an
entity e, with document counts over the whole corpus,

    PMI(t; e) = log(N * n(t, e) / (n(t) * n(e))),   IC(e) = log(N / n(e)),

where n(t, e) counts the documents that have t and e. Of the
information in e, t discloses PMI / IC. A term that discloses ``DISCLOSED`` or more of an entity,
in at least ``LEAST_DOCUMENTS`` different texts, is removed wherever it stands in documents that
have the entity if it does so for that entity alone, and otherwise generalised. Copies of a text support
no term: they say nothing about how terms go together. A term is a run of letters, in lower case, that
overlaps no base span; runs that do are counted nowhere.

Since n(t, e) <= n(e), a term that discloses e is in no more than n(e)^DISCLOSED * N^(1 - DISCLOSED)
documents. Terms and entities of a document are paired within this bound, as far as n(t) is known
before a shuffle: it is for the terms of more than one in ``OFTEN`` documents, which are sent to all tasks.

Patterns are possessive where nothing that follows could make them give back, so that no text,
however long, makes them slow or deep.

Defined cases: a null or empty text has no spans. Spans of different kinds may overlap; spans of
one kind do not. Spans are half-open in code points. Repeated rows and null ids stay rows of their own.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import read_table
from wardline.session import materialize

# Kinds in the order of the result, and what they look like.
LOCAL = "A-Za-z0-9._%+-"
LABEL = "[A-Za-z0-9-]"
KINDS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS = (14, 19)
PHONE_DIGITS = (10, 15)
# Texts without this have no match of the kind.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}

# Parameters of the method.
DISCLOSED = 0.95
LEAST_DOCUMENTS = 3
REMOVED = ""
GENERALISED = "[TERM]"
TERM = r"\p{L}++"
TERM_KIND = "term"
#: What more than one in so many documents have is joined without a shuffle.
OFTEN = 1_000
#: Stands for a base span where terms are counted.
CUT = "\x00"

# Fields in the order by which spans are sorted.
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _spans(
    text: Column, kind: str, rank: int, pattern: str, wanted: Callable[[Column], Column] = lambda value: F.lit(True)
) -> Column:
    """All matches of the pattern that are wanted as spans, in order."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    # What stands between matches; the last piece is behind them all.
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.greatest(F.size(found), F.lit(1)))
    pairs = F.arrays_zip(between.alias("b"), found.alias("f"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["b"])
        end = begin + F.length(pair["f"])
        span = F.struct(
            begin.alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            pair["f"].alias("value"),
        )
        longer = F.when(wanted(pair["f"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), longer.alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, start, add, lambda state: state["spans"])).otherwise(
        F.array().cast(SPAN)
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits' weighted sum, every second one from the right doubled, is divisible by ten."""
    backwards = F.split(F.reverse(_digits(value)), "")
    weighted = F.transform(
        F.filter(backwards, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighted, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Leading zeros do not count; a longer part is above 255.
        parts = F.transform(F.split(value, r"\."), lambda part: F.regexp_replace(part, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda part: (F.length(part) <= 3) & (F.substring(part, 1, 3).cast("int") <= 255))
    low, high = CARD_DIGITS if kind == "card" else PHONE_DIGITS
    length = F.length(_digits(value))
    return (length.between(low, high) & _luhn(value)) if kind == "card" else length.between(low, high)


def _valid_spans(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def base_spans(text: Column) -> Column:
    """Spans of all kinds, by start and then kind."""
    parts = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        spans = _valid_spans(_spans(text, kind, rank, pattern), kind)
        needed = F.contains(text, F.lit(NEEDED[kind])) if NEEDED[kind] else F.lit(True)
        parts.append(F.when(needed, spans).otherwise(F.array().cast(SPAN)))
    has_any = text.rlike("[0-9@]")
    return F.when(has_any, F.array_sort(F.concat(*parts))).otherwise(F.array().cast(SPAN))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text (null without spans), base (spans), added (terms, as spans).

    A span has start, rank (of its kind), end, kind and value; the value of a term is what stands in its place.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    # One pass over the texts. Rows may share an id, so they get a key; it is fixed by writing them.
    scanned = materialize(
        rows.withColumn("base", base_spans(F.col("text"))).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "base",
            F.when(F.size("base") > 0, F.col("text")).alias("text"),
        ),
        "personal-base",
    )
    holding = scanned.where(F.size("base") > 0)
    hits = _hits(rows, holding, scanned.count())
    # Where the terms stand, once the document's are known.
    terms = _spans(F.col("text"), TERM_KIND, len(KINDS), TERM, lambda value: F.map_contains_key("terms", F.lower(value)))
    free = F.filter(terms, lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"])))
    named = F.transform(free, lambda t: t.withField("value", F.element_at("terms", F.lower(t["value"]))))
    added = F.when(F.col("terms").isNotNull(), named).otherwise(F.array().cast(SPAN)).alias("added")
    return scanned.join(hits, "row", "left").select("doc_id", "text", "base", added)


def _terms(text: Column, pattern: str) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.lower))


def _cut(text: Column, base: Column) -> Column:
    """The text with ``CUT`` in place of its base spans."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(state: Column, span: Column) -> Column:
        ahead = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        end = F.greatest(state["at"], span["end"])
        return F.struct(end.alias("at"), F.concat(state["out"], ahead, F.lit(CUT)).alias("out"))

    return F.aggregate(
        base, start, put, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str], often: Column) -> DataFrame:
    """Inner join with a table of unique keys, of which those that are in ``left`` often cross no shuffle."""
    hot, rest = right.where(often), right.where(~often)
    others = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(others.join(rest, keys))


def _hits(rows: DataFrame, holding: DataFrame, total: int) -> DataFrame:
    """The disclosing terms of each row that has some, with what stands in their place: row, terms (a map)."""
    often = total / OFTEN
    named = holding.select(
        "row", F.xxhash64("text").alias("same"), F.explode(F.array_distinct(F.col("base.value"))).alias("entity")
    )
    named = materialize(named, "personal-named")
    # Copies have the same terms and entities: the first of them supports a term.
    first = named.groupBy("same").agg(F.min("row").alias("row")).select("row", F.lit(1).alias("first"))
    named = named.join(first, "row", "left").select("row", "entity", F.coalesce("first", F.lit(0)).alias("first"))
    named = materialize(named, "personal-entities")
    entities = named.groupBy("entity").agg(F.count("*").alias("entity_documents"), F.sum("first").alias("texts"))
    entities = entities.where((F.col("texts") >= LEAST_DOCUMENTS) & (F.col("entity_documents") < total)).drop("texts")
    entities = materialize(entities, "personal-entity-counts")
    own = (
        _joined(named, entities, ["entity"], F.col("entity_documents") > often)
        .groupBy("row", "first")
        .agg(
            F.collect_list(F.struct("entity", "entity_documents")).alias("entities"),
            F.max("entity_documents").alias("most"),
        )
    )

    # Every word of the corpus, each document once per word, but for those in base spans only: summed up before the shuffle.
    free = _terms(_cut(F.col("text"), F.col("base")), rf"(?<![\p{{L}}{CUT}]){TERM}(?!{CUT})")
    words = rows.select(F.explode(_terms(F.col("text"), TERM)).alias("term"), F.lit(1).alias("n"))
    covered = holding.select(F.explode(F.array_except(_terms(F.col("text"), TERM), free)).alias("term"), F.lit(-1).alias("n"))
    terms = words.unionByName(covered).groupBy("term").agg(F.sum("n").alias("term_documents"))
    terms = materialize(terms.where(F.col("term_documents") >= LEAST_DOCUMENTS), "personal-terms")

    def can_disclose(entity_documents: Column) -> Column:
        bound = F.pow(entity_documents, F.lit(DISCLOSED)) * total ** (1 - DISCLOSED)
        return F.col("term_documents").isNull() | (F.col("term_documents") <= bound * (1 + 1e-9))

    hot = F.broadcast(terms.where(F.col("term_documents") > often))
    triples = (
        holding.join(own, "row")
        .select("row", "first", "entities", "most", F.explode(free).alias("term"))
        .join(hot, "term", "left")
        .where(can_disclose(F.col("most")))
        .select("row", "first", "term", "term_documents", F.explode("entities").alias("e"))
        .where(can_disclose(F.col("e.entity_documents")))
        .select("row", "first", "term", "e.entity", "e.entity_documents")
    )
    triples = materialize(triples, "personal-triples")
    disclosing = _disclosing(triples, terms, total)
    return (
        _joined(triples.select("row", "term", "entity"), disclosing, ["term", "entity"], F.col("both") > often)
        .groupBy("row", "term")
        .agg(F.min("in_place").alias("in_place"))
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "in_place"))).alias("terms"))
    )


def _disclosing(triples: DataFrame, terms: DataFrame, total: int) -> DataFrame:
    """Pairs of term and entity with what stands in the term's place: term, entity, both, in_place."""
    pairs = (
        triples.groupBy("term", "entity", "entity_documents")
        .agg(F.count("*").alias("both"), F.sum("first").alias("texts"))
        .where(F.col("texts") >= LEAST_DOCUMENTS)
    )
    pmi = F.log(F.lit(total) * F.col("both") / (F.col("term_documents") * F.col("entity_documents")))
    content = F.log(F.lit(total) / F.col("entity_documents"))
    disclosing = pairs.join(terms, "term").where(pmi >= DISCLOSED * content).select("term", "entity", "both")
    disclosing = materialize(disclosing, "personal-disclosing")
    kinds = disclosing.groupBy("term").agg(F.count("*").alias("entities"))
    in_place = F.when(F.col("entities") == 1, REMOVED).otherwise(GENERALISED)
    return disclosing.join(kinds, "term").select("term", "entity", "both", in_place.alias("in_place"))


def all_spans(base: Column, added: Column) -> Column:
    """Spans by start, then kind."""
    return F.array_sort(F.concat(base, added))


def sanitise(found: DataFrame) -> DataFrame:
    """Texts of ``find_personal_data`` with base spans named by kind and terms removed or generalised: doc_id, text.

    Of overlapping spans the first counts. Texts without spans are null here, as they are there.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def put(state: Column, span: Column) -> Column:
        shown = F.when(span["kind"] == TERM_KIND, span["value"]).otherwise(
            F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        )
        ahead = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        moved = F.struct(span["end"].alias("at"), F.concat(state["out"], ahead, shown).alias("out"))
        return F.when(span["start"] >= state["at"], moved).otherwise(state)

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    clean = F.aggregate(all_spans(F.col("base"), F.col("added")), start, put, rest)
    return found.select("doc_id", F.when(text.isNotNull(), clean).alias("text"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in KINDS),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(all_spans(F.col("base"), F.col("added"))).alias("spans"),
    )
