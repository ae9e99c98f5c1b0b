"""Operators over whole tables, next to brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.samples import SCHEMA, table, words_of
from pyspark.sql import functions as F

from wardline.llm import class_lm, decontaminate, exact_dedup, language, ngram_join, repeats, toxicity
from wardline.llm.components import connected_components


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))


# --- exact copies ---


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_classes(docs, rows, nothing, clashing, keep, weak):
    """With a hash of two values, texts are told apart by their bytes."""
    hash_of = (lambda text: F.length(text) % 2) if weak else exact_dedup.content_hash
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    place = lambda i: -math.inf if i is None else i
    chosen = {t: (max if keep == "largest" else min)(ids, key=place) for t, ids in groups.items()}
    wanted = sorted(
        (
            (i, chosen[t or ""], len(groups[t or ""]), i == chosen[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
            for i, t, *_ in rows
        ),
        key=str,
    )
    assert table(exact_dedup.exact_classes(docs, keep=keep, hash_of=hash_of)) == wanted
    assert table(exact_dedup.exact_classes(clashing, "id", "body", keep, hash_of)) == wanted
    assert exact_dedup.exact_classes(nothing, keep=keep, hash_of=hash_of).isEmpty()


def test_one_row_of_each_text_stays(docs, rows, nothing):
    kept = exact_dedup.deduplicate(docs)
    assert kept.schema == docs.schema and exact_dedup.deduplicate(nothing).isEmpty()
    found = kept.collect()
    assert Counter(r.text or "" for r in found) == Counter({t or "": 1 for _, t, *_ in rows})
    least = {}
    for i, t, *_ in rows:
        least[t or ""] = min(least.get(t or "", math.inf), -1 if i is None else i)
    assert all((-1 if r.doc_id is None else r.doc_id) == least[r.text or ""] for r in found)


# --- near copies ---


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    touched = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: find(n) for n in touched}


def near_components(rows) -> dict:
    sets = []
    for _, t, *_ in rows:
        w = split(t)
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {c: min((m for m in ids if m is not None), default=None) for c, ids in members.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("short_list", [40, 2])
def test_near_duplicates(spark, docs, rows, nothing, clashing, monkeypatch, short_list):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short_list)
    wanted = near_components(rows)
    assert table(ngram_join.near_duplicates(docs)) == wanted
    if short_list == 2:
        assert table(ngram_join.near_duplicates(clashing, "id", "body")) == wanted
        assert ngram_join.near_duplicates(nothing).isEmpty()


@pytest.mark.parametrize("spread", [20_000, 3])
def test_near_duplicates_of_a_large_family(spark, monkeypatch, spread):
    """Edited copies that are linked through their original only, and unrelated texts with a common passage."""
    monkeypatch.setattr(ngram_join, "SPREAD_ENTRIES", spread)
    monkeypatch.setattr(ngram_join, "PART_PAIRS", spread)
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 4)
    rng = random.Random(11)
    base, passage = words_of(rng, 150).split(" "), words_of(rng, 40)
    rows = [(1000, " ".join(base))]
    for k in range(60):
        edited = list(base)
        for e in range(1 + k % 4):
            edited[rng.randrange(len(base))] = f"w{k}x{e}"
        rows.append((k, " ".join(edited)))
    rows += [(100 + k, f"{words_of(rng, 3 + k)} {passage} {words_of(rng, 5)}") for k in range(40)]
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert table(found) == near_components(rows)


def test_prefixes_share_what_the_sizes_require():
    """The bound on shared prefix tokens, on random sets that just reach the similarity."""
    rng = np.random.default_rng(4)
    none = ngram_join.Frequent(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for _ in range(300):
        common = rng.integers(4, 200)
        extra = int(common * 0.25 + 1e-9)
        one = rng.integers(0, extra + 1)
        tokens = rng.permutation(10_000).astype(np.uint64)[: common + extra]
        x, y = np.sort(tokens[: common + one]), np.sort(np.concatenate([tokens[:common], tokens[common + one :]]))
        assert ngram_join._link(x, y)
        shared = len(np.intersect1d(none.prefix(x)[0], none.prefix(y)[0]))
        n, m = len(x), len(y)
        least = max(1, math.ceil(4 * (n + m) / 9 - 1e-9) - math.ceil(max(n, m) * 4 / 5 - 1e-9) + 1)
        assert shared >= least


def test_a_group_is_bounded_by_each_of_its_sizes(spark):
    """The bound that opens a group is no more than what a member of any size from low to high requires."""
    sizes = spark.range(20, 130).selectExpr("cast(id as int) as n")
    low, high = (spark.range(16, 163).selectExpr(f"cast(id as int) as {c}") for c in ("low", "high"))
    groups = sizes.join(low, F.expr("low >= 0.8 * n and low <= 1.25 * n"))
    groups = groups.join(high, F.expr("high >= low and high <= 1.25 * n"))
    each = groups.withColumn("m", F.explode(F.sequence("low", "high")))
    bound = ngram_join._least_of_group(F.col("n"), F.col("low"), F.col("high"))
    each = each.withColumns({"bound": bound, "required": ngram_join._least_shared(F.col("n"), F.col("m"))})
    assert each.where("bound > required").isEmpty()
    assert each.where("n = 100 and low = 105 and high = 110").agg(F.min("required"), F.max("bound")).first() == (6, 6)
    ends = F.least(ngram_join._least_shared(F.col("n"), F.col("low")), ngram_join._least_shared(F.col("n"), F.col("high")))
    assert not each.where(ends > F.col("required")).isEmpty()


# --- repeated passages ---


def removed(rows) -> list[tuple]:
    order = lambda i: -math.inf if i is None else i
    first: dict[bytes, float] = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            first[w] = min(first.get(w, math.inf), order(i))
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        covered = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < order(i):
                covered[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, m in zip(b, covered) if not m)
        spans = sum(1 for k in range(len(b)) if covered[k] and not (k and covered[k - 1]))
        out.append((i, len(b), sum(covered), spans, kept))
    return sorted(out, key=str)


def test_repeats(spark, docs, rows, nothing, clashing):
    wanted = removed(rows)
    assert sum(r[2] for r in wanted) > 1000
    found = [(*r[:4], bytes(r[4])) for r in table(repeats.remove_repeats(docs))]
    assert sorted(found, key=str) == wanted
    found = [(*r[:4], bytes(r[4])) for r in table(repeats.remove_repeats(clashing, "id", "body"))]
    assert sorted(found, key=str) == wanted
    assert repeats.remove_repeats(nothing).isEmpty()


def test_repeats_with_periods_and_partial_overlaps(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        pieces = [rng.choice(["ab" * 40, "x" * rng.randint(45, 60), "lorem ipsum dolor sit amet consectetur adipiscing elit",
                              "".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))]) for _ in range(5)]
        rows.append((rng.randrange(50), "".join(pieces)))
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert sorted([(*r[:4], bytes(r[4])) for r in table(found)], key=str) == removed(rows)


def test_equal_strings_have_their_trigger_at_the_same_place():
    rng = random.Random(9)
    shared = "".join(rng.choice("abcd ") for _ in range(80))
    found = []
    for ahead in ("", "zz" * 31, "abcd " * 9):
        places, _, first, last = repeats.parse((ahead + shared + "tail" * 20).encode())
        trigger = {s: p for p, a, b in zip(places, first, last) for s in range(a, b + 1)}
        found.append([trigger[len(ahead) + s] - len(ahead) for s in range(31)])
    assert found[0] == found[1] == found[2]


def test_ranges_are_hashed_in_memory_for_the_ranges_not_for_the_data():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 101, 6_000_000, np.uint8)
    starts = np.sort(rng.integers(0, len(data) - 200, 3_000)) // 100 * 100
    lengths = rng.integers(repeats.SPAN, 76, len(starts))
    rolled = repeats.rolling_hashes(data, repeats.SPAN)
    places = np.sort(rng.integers(0, len(rolled), 5_000))
    assert (repeats.hashes_at(data, repeats.SPAN, places) == rolled[places]).all()
    assert repeats.hashes_at(data[:10], repeats.SPAN, places[:0]).size == 0
    same = defaultdict(set)
    tracemalloc.start()
    for key, low, n in zip(repeats._range_hashes(data, starts, lengths).tolist(), starts.tolist(), lengths.tolist()):
        same[key].add(bytes(data[low : low + n]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(len(texts) == 1 for texts in same.values())
    assert len(same) == len({bytes(data[a : a + n]) for a, n in zip(starts.tolist(), lengths.tolist())})
    # Eight bytes for each of the data were 48 MB, and several times that while they were mixed.
    assert peak < 8 * len(data)


# --- benchmark leaks ---


def edit_distance(item: list, text: list) -> int:
    row = [0] * (len(text) + 1)
    for word in item:
        new = [row[0] + 1]
        for j, other in enumerate(text):
            new.append(min(row[j] + (word != other), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_are_found_and_verified(spark, nothing):
    rng = random.Random(21)
    items = [(k, words_of(rng, rng.randint(8, 40))) for k in range(12)] + [(50, "too short"), (51, None), (52, "")]
    texts: list[str | None] = [None, "", items[0][1], items[1][1].upper()]
    for k in range(60):
        item = items[k % 12][1].split(" ")
        for _ in range(rng.randint(0, decontaminate.edits_allowed(len(item)) + 2)):
            item[rng.randrange(len(item))] = f"q{rng.randrange(99)}"
        texts.append(f"{words_of(rng, rng.randint(0, 60))} {' '.join(item)} {words_of(rng, rng.randint(0, 60))}")
    texts += [words_of(rng, 100) for _ in range(30)]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    wanted = {}
    for d, t in enumerate(texts):
        for i, w in items:
            item = split(w)
            if len(item) >= decontaminate.LEAST_WORDS:
                distance = edit_distance(item, split(t))
                if distance <= decontaminate.edits_allowed(len(item)):
                    wanted[d, i] = distance
    found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(made, bench).collect()}
    assert all(wanted.get(k) == v for k, v in found.items())
    assert len(found) >= 0.95 * len(wanted) and all(k in found for k, v in wanted.items() if v == 0)
    in_passes = decontaminate.find_leaks(made, bench, sent_bytes=500)
    assert {(r.doc_id, r.item_id) for r in in_passes.collect()} >= {k for k, v in wanted.items() if v == 0}
    clean = decontaminate.without_leaks(made, bench)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in found}
    assert decontaminate.find_leaks(nothing, bench).isEmpty()
    assert decontaminate.find_leaks(made, bench.where("false")).isEmpty()


@pytest.mark.parametrize("kind", ["remove", "insert", "any"])
@pytest.mark.parametrize("n", [8, 15, 20, 40, 80, 150, 300])
def test_leaks_with_as_many_edits_as_allowed_are_found_at_any_length(n, kind):
    rng = random.Random(f"{n} {kind}")
    items = [[f"w{rng.randrange(10**9)}" for _ in range(n)] for _ in range(40)]
    texts = []
    for item in items:
        words = list(item)
        for _ in range(decontaminate.edits_allowed(n)):
            at = rng.randrange(len(words))
            edit = kind if kind != "any" else rng.choice(["remove", "insert", "replace"])
            words[at : at + (edit != "insert")] = [] if edit == "remove" else [f"x{rng.randrange(10**9)}"]
        around = [f"y{rng.randrange(10**9)}" for _ in range(60)]
        texts.append(" ".join(around[:30] + words + around[30:]).encode())
    index = decontaminate.ItemIndex.build(list(range(len(items))), [" ".join(item).encode() for item in items])
    found = {(text, item) for text, item, *_ in index.leaks(texts)}
    assert found == {(k, k) for k in range(len(items))}


def test_items_without_blanks_and_of_few_long_words_are_found():
    rng = random.Random(12)
    signs = [chr(c) for c in (*range(0x4E00, 0x4F00), *range(0x3041, 0x3090))]
    thai = [chr(c) for c in range(0x0E01, 0x0E2F)]
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    items = [draw(signs, 30), draw(thai, 40), "Floccinaucinihilipilification notwithstanding", "too short", draw(signs, 4), "𠀀" * 3 + draw(signs, 12)]
    edited = items[0][:7] + "x" + items[0][9:20] + items[0][21:]
    texts = [draw(signs, 50) + edited + draw(signs, 50), "abc " + draw(thai, 9) + items[1] + "def", "so floccinaucinihilipilification\nNotwithstanding this",
             "floccinaucinihilipilification is notwithstanding", "too short", items[4], draw(signs, 300), "é" + items[5] + "."]
    index = decontaminate.ItemIndex.build(list(range(len(items))), [item.encode() for item in items])
    leaks = {(text, index.ids[item]): distance for text, item, distance, *_ in index.leaks([t.encode() for t in texts])}
    assert leaks == {(0, 0): edit_distance(list(items[0]), list(texts[0])), (1, 1): 0, (2, 2): 0, (7, 5): 0}
    broken = decontaminate.split_words([b"a\xe4\xb8", texts[0].encode(), b"\xe4"], unspaced=True)
    assert len(broken.starts) == len(broken.ends) and (broken.starts < broken.ends).all()


# --- models ---


def test_languages(spark, docs, nothing):
    rng = random.Random(1)
    alphabets = {"aa": "abcdeé", "bb": "vwxyzu", "cc": "mnopqi"}
    word = lambda lang: "".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang, "s", 0) for i, lang in enumerate(list(alphabets) * 40)]
    rows += [(1000, None, "aa", "s", 0), (1001, "12 34 ?!", None, "s", 0), (1002, "жщ юэ ъы", None, "s", 0), (None, "abc", None, "s", 0)]
    made = spark.createDataFrame(rows, SCHEMA).repartition(3)
    models = language.learn_languages(made)
    found = {r.doc_id: r for r in language.identify(made, models).collect()}
    assert all(found[i].lang_pred == lang and 0 <= found[i].score <= 1 for i, _, lang, *_ in rows[:120])
    assert [(found[i].lang_pred, found[i].score, found[i].rejected) for i in (1000, 1001)] == [("und", 0.0, True)] * 2
    assert found[1002].rejected and not any(found[i].rejected for i in range(120))
    kept = language.accepted(made, models)
    assert kept.schema == made.schema and kept.count() == 121
    assert language.learn_languages(nothing) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_every_labelled_language_is_learned(spark, monkeypatch):
    """Languages with one or two documents, and more of them than 512; blocks of few words change nothing."""
    rng = random.Random(5)

    def text(lang: int) -> str:
        letters = [chr(0x4E00 + 8 * lang + k) for k in range(8)]
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(25))

    rows = [(i, text(i % 600), f"x{i % 600:03d}", "s", 0) for i in range(900)] + [(900 + k, text(k), None, "s", 0) for k in range(600)]
    made = spark.createDataFrame(rows, SCHEMA).repartition(3)
    models = language.learn_languages(made)
    assert len(models.languages) == 600
    found = {r.doc_id: r.lang_pred for r in language.identify(made, models).collect()}
    assert sum(found[900 + k] == f"x{k:03d}" for k in range(600)) >= 590
    assert language.accepted(made, models).where("lang is not null").count() == 900
    words = [t for *_, t in [(0, r[1]) for r in rows[:4]] for t in t.split(" ")]
    whole = models.score_words(words)
    monkeypatch.setattr(language, "CELLS", 20_000)
    assert np.allclose(models.score_words(words), whole)
    few = made.where("doc_id < 4")
    assert language.accepted(few, language.learn_languages(few)).count() == 4
    bare = made.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert language.accepted(bare, language.learn_languages(bare)).count() == len(rows)


def test_language_models_sum_to_one():
    """After any context, known or not, the probabilities of all characters and of the end add up to one."""
    import pandas as pd

    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    parts = []
    for size, key, tail, head, opens, n in language._ngram_counts(words, np.ones(len(words))):
        columns = {"size": size, "key": key.view(np.int64), "tail": tail.view(np.int64), "head": head.view(np.int64)}
        parts.append(pd.DataFrame({"lang": "xx", **columns, "opens": opens, "n": n}))
    models = language.LanguageModels.learn(pd.concat(parts))
    for context in ("a", "ab", "cba", "bbbb", "q"):
        # The score of a word is that of its characters and its end; the characters of the context cancel out.
        strings = [context, *(context + c for c in "abcz")]
        letters = [models.character_scores([s])[:, 0] for s in strings]
        n = len(context)
        total = math.exp(letters[0][n + 1]) + sum(math.exp(x[n + 1]) for x in letters[1:])
        assert total == pytest.approx(1)


def test_toxic_texts_stand_out(spark, nothing):
    rng = random.Random(8)
    ordinary = ["table", "garden", "winter", "river", "paper", "window", "summer", "bottle", "silver", "candle"]
    rude = ["blatherskite", "numbskull", "wretch", "scoundrel"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(ordinary) + rng.choice(["", "s", "ing", "ed"]) + rng.choice(["", ".", ","]) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(rude)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(500, None), (501, ""), (502, rude[0] * 2000)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1), (7, None)], "doc_id bigint, label int")
    model = toxicity.learn_toxicity(made, known)
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(made, model).collect()}
    held = [(found[i], t) for i, t in labels if i % 3 == 0]
    assert sum((s >= 0.7) == bool(t) for s, t in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in found.values()) and found[500] < 0.5 and found[501] < 0.5
    assert toxicity.learn_toxicity(made, known.where("label = 0")) is None
    assert {r.score for r in toxicity.score_toxicity(made, None).collect()} == {0.0}
    assert toxicity.score_toxicity(nothing, model).isEmpty()


def test_toxic_passages_of_ordinary_words_stand_out(spark):
    """No word tells, only the order of words does."""
    rng = random.Random(9)
    ordinary = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(3)) for _ in range(150)]
    slurs = [" ".join(rng.choice(ordinary) for _ in range(9)) for _ in range(4)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(ordinary) for _ in range(60)]
        toxic = i % 3 == 0
        if toxic:
            words[rng.randrange(60)] = rng.choice(slurs)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id bigint, label int")
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(made, toxicity.learn_toxicity(made, known)).collect()}
    held = [(found[i], t) for i, t in labels if i % 5 == 0]
    assert sum((s >= 0.7) == bool(t) for s, t in held) >= 0.9 * len(held)


def test_exchange_finds_classes_that_follow_each_other():
    rng = np.random.default_rng(0)
    kinds = np.arange(41) % 4
    pairs = np.where(kinds[None, :] == (kinds[:, None] + 1) % 4, 20.0, 0.2) * rng.uniform(0.8, 1.2, (41, 41))
    found = class_lm.exchange_clusters(pairs, classes=5, sweeps=20)
    assert found[-1] == 4
    for kind in range(4):
        assert len(set(found[:-1][kinds[:-1] == kind].tolist())) == 1
    table = class_lm._by_class(pairs, found, 5)
    assert table.sum() == pytest.approx(pairs.sum())


def test_words_move_to_the_class_under_which_their_bigrams_are_likeliest():
    rng = np.random.default_rng(4)
    size, own = class_lm.CLASSES, class_lm.CLASSES - 1
    table = rng.integers(0, 50, (size, size)).astype(float)
    beside = rng.integers(0, 3, (30, 2 * size)).astype(float)
    smooth = table + class_lm.PRIOR / size
    for word, found in enumerate(class_lm.best_classes(beside, table, own)):
        likelihood = []
        for c in range(own):
            after = sum(n * math.log(smooth[c, d] / smooth[c].sum()) for d, n in enumerate(beside[word, :size]))
            ahead = sum(n * math.log(smooth[d, c] / smooth[d].sum()) for d, n in enumerate(beside[word, size:]))
            likelihood.append(after + ahead - beside[word, :size].sum() * math.log(smooth[:, c].sum()))
        assert found == int(np.argmax(likelihood))


def test_neighbours_cross_the_shuffle_packed_and_add_up(spark, monkeypatch):
    """A task hands on a row for many counts, in batches of bounded size, more than once; words go where all their counts say."""
    monkeypatch.setattr(class_lm, "GATHERED", 600)
    monkeypatch.setattr(class_lm, "TEXT_BYTES", 2_000)
    monkeypatch.setattr(class_lm, "BATCH_BYTES", 1_000)
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.expovariate(0.03))}" for _ in range(rng.randrange(50))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    vocabulary = class_lm.Vocabulary.of(class_lm.frequent_words(class_lm.count_words(docs), 1 << 10).toPandas())
    coarse = np.array([rng.randrange(class_lm.CLASSES - 1) for _ in range(class_lm.END)])
    classes = class_lm.Classes(coarse[vocabulary.symbols], coarse[: class_lm.ENDINGS], class_lm.CLASSES - 1)
    moves = vocabulary.counts >= class_lm.LEAST_COUNT

    wanted = np.zeros((len(moves), 2 * class_lm.CLASSES))
    for text in texts:
        sequence, places, _, which, found = vocabulary.sequence(class_lm.split_words([text.encode()]), classes)
        for word, place in zip(found[which], places):
            if word >= 0 and moves[word]:
                wanted[word, sequence[place + 1]] += 1
                wanted[word, class_lm.CLASSES + sequence[place - 1]] += 1
    for parts in (1, 3, 5_000):
        rows = class_lm.count_neighbours(docs, vocabulary, classes, moves, parts).collect()
        got, size = np.zeros_like(wanted), 2 * class_lm.CLASSES
        for r in rows:
            keys, times = np.frombuffer(r.keys, np.int64), np.frombuffer(r.times, np.int64)
            assert len(set(keys.tolist())) == len(keys) == len(times) <= class_lm.GATHERED + 1_000
            got[keys // size * parts + r.part, keys % size] += times
        assert (got == wanted).all()
        assert 2 < len(rows) and (parts > 3 or len(rows) < np.count_nonzero(wanted) / 20)

    table = np.array([[rng.randrange(1, 50) for _ in range(class_lm.CLASSES)] for _ in range(class_lm.CLASSES)], float)
    moved = class_lm.move_words(docs, vocabulary, classes, table, moves).of_word
    best = class_lm.best_classes(wanted, table, classes.of_end)
    assert (moved == np.where(moves, best, classes.of_word)).all() and (~moves).any()

    batch = class_lm._neighbour_rows(np.arange(9_600), np.ones(9_600, np.int64), 64)
    pieces = list(class_lm._pieces(batch))
    assert len(pieces) > 1 and class_lm.pa.Table.from_batches(pieces).equals(class_lm.pa.Table.from_batches([batch]))
    assert max(p.num_rows for p in pieces) * batch.nbytes / batch.num_rows <= max(1_000, batch.nbytes / 64)


def test_exchange_goes_on_until_no_symbol_gains():
    """After any fixed number of sweeps some symbols may still be better off in another class."""
    rng = np.random.default_rng(3)
    pairs = np.floor(rng.pareto(0.7, (300, 300)))
    found = class_lm.exchange_clusters(pairs, classes=12)
    assert class_lm.likelihood(class_lm._by_class(pairs, found, 12)) > class_lm.likelihood(
        class_lm._by_class(pairs, class_lm.exchange_clusters(pairs, classes=12, sweeps=12), 12)
    )
    reached = class_lm.likelihood(class_lm._by_class(pairs, found, 12))
    for symbol in range(299):
        for c in range(11):
            other = found.copy()
            other[symbol] = c
            assert class_lm.likelihood(class_lm._by_class(pairs, other, 12)) <= reached + 1e-4


def test_words_are_exchanged_until_they_rest(spark):
    """Not in one round: words whose neighbours move have to move again."""
    rng = random.Random(12)
    kinds = [[f"k{k}x{i}{'abcdefgh'[rng.randrange(8)]}" for i in range(120)] for k in range(20)]
    texts = []
    for _ in range(900):
        kind, words = rng.randrange(20), []
        for _ in range(50):
            kind = (kind * 7 + 3) % 20 if rng.random() < 0.8 else rng.randrange(20)
            words.append(rng.choice(kinds[kind]))
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    vocabulary = class_lm.Vocabulary.of(class_lm.frequent_words(class_lm.count_words(docs), 1 << 18).toPandas())
    units = class_lm.materialize(class_lm.as_units(docs, vocabulary), "units")
    pairs = class_lm.count_pairs(units, vocabulary)
    assert (pairs == class_lm.count_pairs(docs, vocabulary)).all() and pairs.sum() == 900 * 51
    coarse = class_lm.exchange_clusters(pairs)
    classes = class_lm.Classes(coarse[vocabulary.symbols], coarse[: class_lm.ENDINGS], int(coarse[-1]))
    table = class_lm.count_classes(units, vocabulary, classes)
    assert (table == class_lm._by_class(pairs, coarse, class_lm.CLASSES)).all()

    moves = vocabulary.counts >= class_lm.LEAST_COUNT
    once = class_lm.move_words(units, vocabulary, classes, table, moves)
    after_one = class_lm.likelihood(class_lm.count_classes(units, vocabulary, once))
    found, rested = class_lm.exchange_words(units, vocabulary, classes, table, moves)
    assert (rested == class_lm.count_classes(docs, vocabulary, found)).all()
    least = class_lm.SETTLED * table.sum()
    assert class_lm.likelihood(rested) > max(after_one, class_lm.likelihood(table)) + least
    model, _ = class_lm.ClassModel.learn(docs)
    assert (model.classes.of_word == found.of_word).all()


def test_class_model_next_to_brute_force(spark, monkeypatch):
    """Neighbours, class bigrams and scores of every text, counted word by word."""
    monkeypatch.setattr(class_lm, "HEAD_WORDS", 80)
    rng = random.Random(5)
    texts = [(i, words_of(rng, rng.randrange(40))) for i in range(60)] + [(None, ""), (7, "of of a")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    model, rare = class_lm.ClassModel.learn(docs)
    known = {int(h): i for i, h in enumerate(model.vocabulary.words.tolist())}

    def tokens(text):
        words = split(text)
        if not words:
            return [], []
        cut = class_lm.split_words([text.encode()])
        endings = class_lm._endings(cut, np.arange(len(words)))
        numbers = [known.get(int(h)) for h in cut.hashes.tolist()]
        of = [model.classes.of_ending[e] if n is None else model.classes.of_word[n] for n, e in zip(numbers, endings)]
        return words, [int(c) for c in of]

    end = model.classes.of_end
    sequences = [tokens(t) for _, t in texts]
    counts = Counter(w for words, _ in sequences for w in words)
    class_of = {w: c for words, classes in sequences for w, c in zip(words, classes)}
    bigrams = Counter(b for _, classes in sequences for b in zip([end, *classes], [*classes, end]))
    table = class_lm.count_classes(docs, model.vocabulary, model.classes)
    assert {b: int(n) for b, n in np.ndenumerate(table) if n} == dict(bigrams)

    total = sum(counts.values()) + len(texts)
    mass, kinds = Counter({end: len(texts)}), Counter({end: 1})
    for word, n in counts.items():
        mass[class_of[word]] += n
        kinds[class_of[word]] += 1
    share = {c: (mass[c] + 0.5) / (total + 0.5 * class_lm.CLASSES) for c in range(class_lm.CLASSES)}
    found = {}
    for r in class_lm.score_documents(docs, model, rare).collect():
        found.setdefault(r.doc_id, []).append(r.score)
    for (doc_id, _), (words, classes) in zip(texts, sequences):
        score, before = 0.0, end
        for word, c in zip([*words, None], [*classes, end]):
            after = sum(n for (a, _), n in bigrams.items() if a == before)
            score += math.log10((bigrams[before, c] + class_lm.PRIOR * share[c]) / (after + class_lm.PRIOR))
            n = len(texts) if word is None else counts[word]
            score += math.log10((n + class_lm.DELTA) / (mass[c] + class_lm.DELTA * (kinds[c] + 1)))
            before = c
        assert min(abs(score - s) for s in found[doc_id]) < 1e-6


def test_the_number_of_clustered_words_grows_with_the_input(spark):
    rng = random.Random(6)
    clustered = []
    for n in (60, 600):
        rows = [(i, " ".join(f"w{rng.randrange(6 * n)}" for _ in range(40))) for i in range(n)]
        model, _ = class_lm.ClassModel.learn(spark.createDataFrame(rows, "doc_id bigint, text string"))
        clustered.append(int((model.vocabulary.counts >= class_lm.LEAST_COUNT).sum()))
    assert clustered[1] > 5 * clustered[0] and clustered[1] > class_lm.TOP_WORDS


def test_class_model_scores(spark, docs, rows, nothing, clashing, monkeypatch):
    """Base figures next to brute force, with and without words that only a shuffle can count."""
    trained = [(i, t) for i, t, *_ in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    counts = Counter(w for _, t in trained for w in [*split(t), "\n"])
    total, kinds = sum(counts.values()), len(counts)
    wanted = []
    for i, t, *_ in rows:
        tokens = [*split(t), "\n"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        wanted.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    for head in (1 << 18, 60):
        monkeypatch.setattr(class_lm, "HEAD_WORDS", head)
        model, rare = class_lm.ClassModel.learn(class_lm.training_documents(docs.selectExpr("doc_id", "coalesce(text, '') as text")))
        found = table(class_lm.score_documents(docs, model, rare))
        assert [r[:4] for r in found] == [w[:4] for w in sorted(wanted, key=str)]
        assert np.allclose([r[4] for r in found], [w[4] for w in sorted(wanted, key=str)])
        assert all(r[5] < 0 for r in found)
        # Probabilities of what can follow a class add up to one.
        assert np.allclose((10**model.log_next).sum(1), 1)
    assert class_lm.score_documents(nothing, model, rare).isEmpty()
    assert len(table(class_lm.score_documents(clashing, model, rare, "id", "body"))) == len(rows)
