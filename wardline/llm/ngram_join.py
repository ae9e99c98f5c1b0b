"""Near-duplicate texts: an exact Jaccard join on word shingles with a token-group matrix.

A document's set holds the hashes of its distinct runs of ``WORDS`` words. Two documents link
when their sets have a Jaccard similarity of ``SHARE`` or more. The result is the components of
that relation, so a link whose ends are known to be connected need not be looked at.

1. Equal sets are one class, known by a 64-bit digest of the set.
2. In an order of tokens that all documents share, two sets that link have a token in common among
   the first n - ceil(SHARE * n) + 1 of each. Tokens that very many documents hold come last in
   the order, which keeps them out of these prefixes. Documents that share a prefix token form
   the token's list; lists with the same members are one list with a weight.
3. Short lists: all pairs of a list, with the number of prefix tokens that they share. Sets that
   link share a number of prefix tokens that follows from their sizes; only such pairs are
   verified, each document with the one that it shares most with first, then those not yet connected.
4. Long lists are not turned into pairs. Each member is verified against the list's centre, which
   gathers similar documents into groups. What is left are members of one list in
   different groups. The token-group matrix holds for each token list the groups in it. How many
   prefix tokens a document can share with a group is bounded by its lists from the first that the group
   is in, shortest first, and by the lists of the group's members; only groups whose bound reaches what
   the sizes require are opened, and then only their members that reach it themselves are verified.

Token lists of tokens with very many documents are never gathered in one task: their entries are
spread by document, and lists longer than ``SHORT_LIST`` remain rows.

Sets are compared by 64-bit hashes of their runs; within a pair of 10^5 runs each, the chance of a
false common run is 5e-10.

Defined cases: a text with fewer words than ``WORDS`` has all of them as its only run; a null
or empty text, or one of white space only, has no run and links with nothing. Repeated rows and
copies are in one component. A null id counts as no id: it is nobody's component unless all
documents of it have none. Very long texts are one set. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.class_lm import frequent_words
from wardline.llm.common import batch_chunks, chunks, free_name, id_and_text, partitions, read_table, written, zipped
from wardline.llm.components import connected_components
from wardline.llm.words import BASE, U64, mix, split_words
from wardline.session import materialize

WORDS = 5
# The share as a fraction of integers: comparisons are exact.
SHARE = (4, 5)

# Lists up to this long are turned into pairs.
SHORT_LIST = 40
# A task reports tokens that this many of its texts hold; sums of reports order the frequent tokens.
FREQUENT_LEAST = 2
# At most this many frequent tokens are put last; which ones does not change the result.
FREQUENT_TOKENS = 1 << 17
# Pairs of one set that a task verifies, and sets whose pairs may be dealt to several tasks.
PART_PAIRS = 128
HOT_SETS = 100_000
# Entries of a frequent token are spread over so many parts of the shuffle that each gets about this many.
SPREAD_ENTRIES = 20_000
# Texts are turned into sets in groups of about this many bytes.
GROUP_BYTES = 500_000
# Tokens that a task gathers before it hands them on.
GATHERED = 1_000_000

MULTIPLIERS = [U64(pow(BASE, k + 2, 1 << 64) | 1) for k in range(WORDS)]
SET_SCHEMA = "doc_id bigint, n int, set bigint, token bigint, documents bigint"
ENTRY_SCHEMA = "part int, tokens binary, sets binary"
LIST_SCHEMA = "list bigint, weight bigint, set bigint"


def token_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct hashes of the runs of words in each text."""
    words = split_words(texts)
    hashes = np.concatenate([words.hashes, np.zeros(WORDS, U64)])
    runs = np.zeros(len(words.hashes), U64)
    for k, multiplier in enumerate(MULTIPLIERS):
        runs += hashes[k : k + len(runs)] * multiplier
    runs = mix(runs)
    first = words.first.tolist()
    out = []
    for low, high in zip(first, first[1:]):
        if high - low >= WORDS:
            found = np.sort(runs[low : high - WORDS + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        else:
            few = words.hashes[low:high]
            total = (few * np.array(MULTIPLIERS[: len(few)], U64)).sum(keepdims=True) + U64(len(few))
            out.append(mix(total) if len(few) else few)
    return out


def _digest(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prefix_length(n: int) -> int:
    return n + (-SHARE[0] * n) // SHARE[1] + 1


# --- sets and frequent tokens ---


def _sets(docs: DataFrame) -> DataFrame:
    """Per document its set's digest and size; and tokens that are frequent among the texts of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held, seen = [], 0, set()
        for ids, texts in batch_chunks(batches, GROUP_BYTES):
            sets = token_sets(texts)
            digests = [_digest(s) for s in sets]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(digests, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                ],
                names=["doc_id", "n", "set", "token", "documents"],
            )
            for digest, tokens in zip(digests, sets):
                if digest not in seen:
                    seen.add(digest)
                    gathered.append(tokens)
                    held += len(tokens)
            if held >= GATHERED:
                yield _frequent(gathered)
                gathered, held, seen = [], 0, set()
        if gathered:
            yield _frequent(gathered)

    return docs.mapInArrow(run, SET_SCHEMA)


def _frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
    tokens, n = np.unique(np.concatenate(sets), return_counts=True)
    often = n >= FREQUENT_LEAST
    tokens, n = tokens[often], n[often]
    empty = [pa.nulls(len(tokens), t) for t in (pa.int64(), pa.int32(), pa.int64())]
    return pa.RecordBatch.from_arrays(
        [*empty, pa.array(tokens.view(np.int64)), pa.array(n.astype(np.int64))],
        names=["doc_id", "n", "set", "token", "documents"],
    )


@dataclass
class Frequent:
    """Frequent tokens in sorted order, and how many documents hold each, roughly."""

    tokens: np.ndarray
    documents: np.ndarray

    def places(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, at, -1)

    def prefix(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first tokens of a set, the frequent behind all others, and the place of each among the frequent."""
        length = _prefix_length(len(tokens))
        places = self.places(tokens)
        rare = np.flatnonzero(places < 0)[:length]
        if len(rare) < length:
            often = np.flatnonzero(places >= 0)
            often = often[np.lexsort((tokens[often], self.documents[places[often]]))]
            rare = np.concatenate([rare, often[: length - len(rare)]])
        return tokens[rare], places[rare]


# --- token lists ---


def _token_lists(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """Documents that share prefix tokens: list, weight (tokens with just these members), set."""
    spark = docs.sparkSession
    parts = 4 * partitions(spark)
    shared = spark.sparkContext.broadcast(frequent)

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held, seen = [], 0, set()
        for _, texts in batch_chunks(batches, GROUP_BYTES):
            for tokens in token_sets(texts):
                if not len(tokens) or (digest := _digest(tokens)) in seen:
                    continue
                seen.add(digest)
                prefix, places = shared.value.prefix(tokens)
                spread = np.zeros(len(prefix), np.int64)
                often = places >= 0
                if often.any():
                    spread[often] = digest % (1 + shared.value.documents[places[often]] // SPREAD_ENTRIES)
                gathered.append((prefix, spread, digest))
                held += len(prefix)
            if held >= GATHERED:
                yield _entries(gathered, parts)
                gathered, held, seen = [], 0, set()
        if gathered:
            yield _entries(gathered, parts)

    def lists(table: pa.Table) -> pa.Table:
        tokens, sets = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("tokens", U64), ("sets", np.int64))
        )
        order = np.lexsort((sets, tokens))
        tokens, sets = tokens[order], sets[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (sets[1:] != sets[:-1])
        tokens, sets = tokens[new], sets[new]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        lengths = np.diff(np.append(starts, len(tokens)))
        often = shared.value.places(tokens[starts])
        spread = (often >= 0) & (shared.value.documents[np.maximum(often, 0)] >= SPREAD_ENTRIES if len(shared.value.documents) else False)
        # Lists with the same members are one; a list of which others hold parts goes by its token.
        members = mix(sets.view(U64))
        names = mix(np.add.reduceat(members, starts) + lengths.astype(U64))
        names = np.where(spread, tokens[starts], names)
        keep = (lengths > 1) | spread
        unique, sample, weight = np.unique(names[keep], return_index=True, return_counts=True)
        chosen = np.flatnonzero(keep)[sample]
        of = np.repeat(np.arange(len(chosen)), lengths[chosen])
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[chosen].tolist(), lengths[chosen].tolist())] or [[]])
        at = at.astype(np.int64)
        return pa.table(
            {
                "list": unique.view(np.int64)[of],
                "weight": weight[of].astype(np.int64),
                "set": sets[at],
            }
        )

    found = docs.mapInArrow(entries, ENTRY_SCHEMA).groupBy("part").applyInArrow(lists, LIST_SCHEMA)
    # Parts of the shuffle count their own tokens of a list; parts of a spread list hold different members.
    return found.groupBy("list", "set").agg(F.sum("weight").alias("weight"))


def _entries(gathered: list[tuple], parts: int) -> pa.RecordBatch:
    tokens = np.concatenate([g[0] for g in gathered])
    spread = np.concatenate([g[1] for g in gathered])
    lengths = [len(g[0]) for g in gathered]
    sets = np.repeat(np.array([g[2] for g in gathered], np.int64), lengths)
    part = ((mix(tokens + spread.astype(U64)) >> U64(20)) % U64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    numbers, first = np.unique(part[order], return_index=True)
    cuts = [*first.tolist(), len(order)]
    columns = [[x[order[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (tokens, sets)]
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers.astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)],
        names=["part", "tokens", "sets"],
    )


# --- pairs ---


def _may_link(n: Column, m: Column) -> Column:
    """Sets of these sizes can reach the share at all."""
    return SHARE[1] * F.least(n, m) >= SHARE[0] * F.greatest(n, m)


def _least_shared(n: Column, m: Column) -> Column:
    """How many prefix tokens two sets that link have in common at least.

    They share o = ceil(SHARE / (1 + SHARE) * (n + m)) tokens or more. The k-th of them is at most
    at place k + n - o of the one set and k + m - o of the other, so those up to the prefix length less
    n - o and m - o lie in both prefixes.
    """
    up, down = SHARE
    common = F.ceil((n + m) * up / (up + down) - 1e-9)
    larger = F.greatest(n, m)
    return F.greatest(common - F.ceil(larger * up / down - 1e-9) + 1, F.lit(1))


def _least_of_group(n: Column, low: Column, high: Column) -> Column:
    """A bound from below of ``_least_shared`` for partners of any size from low to high.

    Up to n the requirement grows with the partner. Beyond n it falls but for its two ceilings: what is
    rounded makes it one less at most than it is for the largest partner.
    """
    beyond = _least_shared(n, high) - F.when(high > n, 1).otherwise(0)
    return F.greatest(F.least(_least_shared(n, low), beyond), F.lit(1))


def _verified(pairs: DataFrame, sets: DataFrame, named: DataFrame, total: int) -> DataFrame:
    """Pairs (a, b) whose sets link, from pairs that bring the set of b: a, b, tokens_b.

    A set that more than ``PART_PAIRS`` others are compared with goes to several tasks, each with its part of
    them. ``named`` is the a of each pair, ``total`` bounds their number.
    """
    part = max(PART_PAIRS, -(-total // HOT_SETS))
    several = named.groupBy("a").count().where(F.col("count") > part)
    # At most HOT_SETS rows.
    several = F.broadcast(materialize(several.select("a", F.ceil(F.col("count") / part).alias("parts")), "hot-sets"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                _link(np.frombuffer(x, U64), np.frombuffer(y, U64))
                for x, y in zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(linked, pa.bool_())
            )

    parts = F.coalesce("parts", F.lit(1).cast("bigint"))
    dealt = pairs.join(several, "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), parts)).drop("parts")
    owners = sets.select(F.col("set").alias("a"), F.col("tokens").alias("tokens_a")).join(several, "a", "left")
    owners = owners.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("parts")
    joined = dealt.join(owners, ["a", "part"])
    return joined.mapInArrow(check, "a bigint, b bigint")


def _link(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return SHARE[1] * common >= SHARE[0] * (len(x) + len(y) - common)


def _named(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs with the components of their ends; a set without links is its own."""
    for side in ("a", "b"):
        own = components.select(F.col("node").alias(side), F.col("component").alias(f"component_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"component_{side}", F.coalesce(f"component_{side}", side))
    return pairs


def _apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    return _named(pairs, components).where("component_a != component_b").select("a", "b")


def _between(links: DataFrame, components: DataFrame) -> DataFrame:
    """Links as edges between components."""
    return _named(links, components).select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))


def _short_pairs(members: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs of short lists that share enough prefix tokens: a, b, shared."""
    short = members.join(lists.where(F.col("members") <= SHORT_LIST).select("list"), "list")
    long_weight = (
        members.join(lists.where(F.col("members") > SHORT_LIST).select("list"), "list")
        .groupBy("set")
        .agg(F.sum("weight").alias("long"))
    )
    one = short.select("list", "weight", F.col("set").alias("a"), F.col("n").alias("n_a"))
    other = short.select("list", F.col("set").alias("b"), F.col("n").alias("n_b"))
    pairs = (
        one.join(other, "list")
        .where((F.col("a") < F.col("b")) & _may_link(F.col("n_a"), F.col("n_b")))
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.sum("weight").alias("shared"))
    )
    for side in ("a", "b"):
        own = long_weight.select(F.col("set").alias(side), F.col("long").alias(f"long_{side}"))
        pairs = pairs.join(own, side, "left")
    # What two sets share in long lists is not counted; it is no more than what either has there.
    beyond = F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    return pairs.where(F.col("shared") + beyond >= _least_shared(F.col("n_a"), F.col("n_b"))).select("a", "b", "shared")


def _star_pairs(members: DataFrame, lists: DataFrame, entries: int) -> DataFrame:
    """Members of long lists with the centre of the list: a, b, shared.

    The centre is the member that shares most prefix tokens in long lists: the text from which
    edited copies were made has no rare tokens of its own, so more of its prefix is shared.
    """
    long = members.join(lists.where(F.col("members") > SHORT_LIST).select("list"), "list")
    weights = long.groupBy("set").agg(F.sum("weight").alias("total"))
    long = written(long.join(weights, "set"), "long-lists", entries)
    centre = F.max_by(F.struct("set", "n"), F.struct("total", -F.col("set"))).alias("centre")
    centres = long.groupBy("list").agg(centre).select("list", "centre.*").toDF("list", "a", "n_a")
    centres = written(centres, "centres", entries)
    pairs = long.join(centres, "list").where((F.col("set") != F.col("a")) & _may_link(F.col("n"), F.col("n_a")))
    return pairs.groupBy("a", F.col("set").alias("b")).agg(F.sum("weight").alias("shared"))


def _matrix_pairs(members: DataFrame, lists: DataFrame, components: DataFrame, entries: int) -> DataFrame:
    """Members of long lists in different groups, by the token-group matrix: a, b."""
    own = components.select(F.col("node").alias("set"), "component")
    long = members.join(lists.where(F.col("members") > SHORT_LIST), "list").join(own, "set", "left")
    rows = long.withColumn("grp", F.coalesce("component", "set")).drop("component")
    several = rows.groupBy("list").agg(F.min("grp").alias("least"), F.max("grp").alias("most")).where("least < most")
    # A document's lists from the shortest on. What it can share with anyone is the weight from the first
    # list that they have in common to the last.
    order = Window.partitionBy("set").orderBy("members", "list")
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.join(several.select("list"), "list").withColumn("rest", rest)
    rows = written(rows.withColumn("total", F.max("rest").over(Window.partitionBy("set"))), "token-rows", entries)
    # Which groups are in a list, with the sizes of their members there and the most that one can share.
    matrix = rows.groupBy("list", F.col("grp").alias("other")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("total").alias("most")
    )
    matrix = written(matrix, "token-groups", entries)
    # A group can be reached from both sides; the side of the larger group name asks.
    up, down = SHARE
    fits = (F.col("n") * down >= F.col("low") * up) & (F.col("high") * down >= F.col("n") * up)
    reaches = F.least("rest", "most") >= _least_of_group(F.col("n"), F.col("low"), F.col("high"))
    opened = rows.join(matrix, "list").where((F.col("grp") > F.col("other")) & fits & reaches)
    # Lists have one order for all documents, so the first that two have in common is the same for both.
    inside = rows.select(
        "list", F.col("grp").alias("other"), F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b")
    )
    required = _least_shared(F.col("n"), F.col("n_b"))
    pairs = (
        opened.select("list", "other", "set", "n", "rest")
        .join(inside, ["list", "other"])
        .where(_may_link(F.col("n"), F.col("n_b")) & (F.least("rest", "rest_b") >= required))
        .select("set", "b", "n", "n_b")
        .distinct()
    )
    # What they share in all lists, by the weights of each document's lists: a row for each pair.
    held = rows.groupBy("set").agg(F.collect_list(F.struct("list", "weight")).alias("held"))
    theirs = held.select(F.col("set").alias("b"), F.map_from_entries("held").alias("theirs"))
    shared = F.aggregate(
        "held", F.lit(0).cast("bigint"), lambda total, e: total + F.coalesce(F.element_at("theirs", e["list"]), F.lit(0))
    )
    counted = pairs.join(held, "set").join(theirs, "b").where(shared >= required)
    return counted.select(F.col("set").alias("a"), "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least id in the document's component)."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    scanned = materialize(_sets(rows), "shingle-sets")
    described = scanned.where("token is null").select("doc_id", "n", "set")
    reports = scanned.where("token is not null").groupBy("token").agg(F.sum("documents").alias("n"))
    frequent = frequent_words(materialize(reports, "frequent-tokens"), FREQUENT_TOKENS).toPandas()
    tokens = frequent["token"].to_numpy(np.int64).view(U64)
    order = np.argsort(tokens)
    found = Frequent(tokens[order], frequent["n"].to_numpy(np.int64)[order])

    sizes = described.select("set", "n").distinct()
    members = materialize(_token_lists(rows, found).join(sizes, "set"), "token-lists")
    lists = members.groupBy("list").agg(F.count("*").alias("members")).where("members > 1")
    entries = members.count()
    lists = written(lists, "token-list-sizes", entries)
    pairs = materialize(_short_pairs(members, lists).unionByName(_star_pairs(members, lists, entries)), "pairs")
    # Each document with the one that it shares most with: most pairs are connected then.
    nearest = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    nearest = nearest.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    sets = _needed_sets(rows, described, nearest, members, lists)

    first = sets.where("a is not null").select("a", F.col("set").alias("b"), F.col("tokens").alias("tokens_b"))
    compared = sets.count()
    links = _verified(first, sets, first.select("a"), compared)
    components = written(connected_components(links), "components", compared)
    rest = pairs.select("a", "b").unionByName(_matrix_pairs(members, lists, components, entries)).distinct()
    rest = materialize(_apart(rest, components), "more-pairs")
    more = _verified(rest.join(sets.select(F.col("set").alias("b"), F.col("tokens").alias("tokens_b")), "b"), sets, rest.select("a"), rest.count())
    more = materialize(more, "links")
    if not more.isEmpty():
        # Components that the rest connects, found among components.
        joined = connected_components(_between(more, components)).withColumnRenamed("component", "joined")
        named = components.join(joined.withColumnRenamed("node", "component"), "component", "left")
        named = named.select("node", F.coalesce("joined", "component").alias("component"))
        alone = joined.join(components, "node", "left_anti").withColumnRenamed("joined", "component")
        components = written(named.unionByName(alone), "components", compared)
    return _with_components(described, components)


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that name their component, all columns as they are: one of each component."""
    found = near_duplicates(docs, id_col, text_col)
    kept = free_name(docs, "kept")
    named = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(kept))
    named = materialize(named.distinct(), "representatives")
    # They grow with the corpus: the join is the same shuffle for any number of them.
    return docs.join(named.hint("merge"), F.col(f"`{id_col}`").eqNullSafe(F.col(kept)), "left_semi")


def _needed_sets(rows: DataFrame, described: DataFrame, nearest: DataFrame, members: DataFrame, lists: DataFrame) -> DataFrame:
    """The sets that may have to be compared: set, tokens, and the set that each is compared with first (a)."""
    # Which members of long lists meet is known only when groups are. Both ends of a pair have a nearest.
    wanted = members.join(lists.where(F.col("members") > SHORT_LIST).select("list"), "list").select("set")
    wanted = wanted.unionByName(nearest.select(F.col("b").alias("set"))).distinct()
    holders = described.join(wanted, "set", "left_semi").groupBy("set").agg(F.min("doc_id").alias("doc_id"))
    first = nearest.select(F.col("b").alias("set"), "a")
    holders = written(holders.join(first, "set", "left"), "set-holders", members.count())
    packed = zipped(rows)
    # Holders grow with the corpus: the join is the same shuffle for any number of them.
    texts = packed.join(holders.hint("merge"), packed["doc_id"].eqNullSafe(holders["doc_id"])).select("set", "a", "zipped")

    def tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            named = list(zip(batch.column("set").to_pylist(), batch.column("a").to_pylist()))
            for names, texts in chunks(named, [unpack.decompress(z) for z in batch.column("zipped").to_pylist()], GROUP_BYTES):
                # Rows may share an id: only a text with the wanted set counts.
                kept = [(*name, s.tobytes()) for name, s in zip(names, token_sets(texts)) if _digest(s) == name[0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[i] for k in kept], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                    names=["set", "a", "tokens"],
                )

    # Rows that agree in id and text give a set twice, and its links twice, which changes nothing.
    return materialize(texts.mapInArrow(tokens, "set bigint, a bigint, tokens binary"), "token-sets")


def _with_components(described: DataFrame, components: DataFrame) -> DataFrame:
    own = components.select(F.col("node").alias("set"), "component")
    classes = described.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"))
    grouped = classes.join(own, "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "component").select("set", "component_id")
    named = written(named, "set-components", described.count())
    full = described.where("n > 0").join(named, "set")
    empty = described.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id"]
    return full.select(*columns).unionByName(empty.select(*columns))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
