import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymill.llm import language_id, queries, spelling, vector_codes

SF_DIR = "/root/testdata/sf0.001"


# Languages


class PlainModel:
    """Words first, then runs, counted over lists in memory."""

    def __init__(self, rows):
        self.langs = sorted({lang for lang, _ in rows if lang is not None})
        docs, words, runs = Counter(), Counter(), Counter()
        for lang, text in rows:
            if lang is None:
                continue
            docs[lang] += 1
            for word in plain_words(text):
                words[lang, word] += 1
                for size in (1, 2, 3, 4):
                    padded = word if size == 1 else f" {word} "
                    for i in range(len(padded) - size + 1):
                        runs[lang, padded[i : i + size]] += 1
        self.prior = [math.log(docs[x] / sum(docs.values())) for x in self.langs]
        self.words = self.table(words)
        self.runs = {}
        for size in (1, 2, 3, 4):
            self.runs |= self.table(Counter({k: n for k, n in runs.items() if len(k[1]) == size}))

    def table(self, counts):
        totals = Counter()
        for (lang, _), n in counts.items():
            totals[lang] += n
        count = len(self.langs)
        least = count / max(1, min(language_id.MOST_KNOWN, language_id.MOST_CELLS // count))
        known = {x for (lang, x), n in counts.items() if n >= max(1.0, least * totals[lang])}
        share = lambda x, lang: math.log((counts[lang, x] + 0.5) / (totals[lang] + 0.5 * max(1, len(known))))
        return {x: [share(x, lang) for lang in self.langs] for x in known}

    def judge(self, text):
        words = plain_words(text)
        if not words or not self.langs:
            return "und", 0.0
        total = list(self.prior)
        for word in words:
            rows = [self.words[word]] if word in self.words else []
            if not rows:
                padded = f" {word} "
                for i in range(len(padded)):
                    for size in (4, 3, 2, 1):
                        if i + size <= len(padded) and padded[i : i + size] in self.runs:
                            rows.append(self.runs[padded[i : i + size]])
                            break
            if rows:
                total = [t + sum(c) / len(rows) for t, c in zip(total, zip(*rows))]
        best = max(range(len(total)), key=lambda i: (total[i], -i))
        return self.langs[best], 1 / sum(math.exp(min(700, t - total[best])) for t in total)


def plain_words(text):
    words, word = [], ""
    for c in unicodedata.normalize("NFC", text or "").lower() + " ":
        kind = unicodedata.category(c)[0]
        if kind == "L" or (kind == "M" and word):
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


def test_languages_against_a_plain_model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang", "text").collect()
    model = PlainModel([(r.lang, r.text) for r in docs if zlib.crc32(str(r.doc_id).encode()) % 5])
    texts = {r.doc_id: r.text for r in docs}
    got = queries.QUERIES["op11_language_id"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        lang, score = model.judge(texts[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.lang_pred == lang and math.isclose(r.score, score, abs_tol=1e-3)


def test_languages_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.QUERIES["op11_language_id"](spark, sf_dir).filter("held_out")
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("x")).agg(F.avg("x"), F.count("x")).first()
    assert right[1] > 100 and right[0] > 0.97


def test_languages_of_unknown_words_short_texts_and_odd_rows(spark, odd_docs, no_docs):
    model = language_id.train(spark.createDataFrame(
        [("und der die nicht lich keit", "de"), ("the and that with ing tion", "en"), (None, "en"), ("12 34", "de"), ("x", None)],
        "text STRING, lang STRING",
    ))
    asked = [("nichtlich",), ("thing",), ("",), (None,), ("1234 !?",), ("THE",), ("Dér",), ("漢字",), ("thing" * 200_000,), ("und " * 50_000,)]
    answers = [tuple(r) for r in language_id.predict(spark.createDataFrame(asked, "text STRING"), model).select("lang_pred", "score").collect()]
    assert [a[0] for a in answers[:6]] == ["de", "en", "und", "und", "und", "en"]
    assert [a[0] for a in answers[8:]] == ["en", "de"] and all(0 <= a[1] <= 1 for a in answers)
    # Decomposed letters are the composed ones.
    twice = spark.createDataFrame([("é" * 3,), ("é" * 3,)], "text STRING")
    a, b = language_id.predict(twice, model).collect()
    assert a.score == b.score
    # Odd rows, clashing columns, empty tables, nothing learned.
    clash = odd_docs.withColumn("score", F.lit("mine"))
    assert language_id.predict(clash, model).count() == odd_docs.count()
    assert language_id.predict(no_docs, model).count() == 0
    empty = language_id.train(no_docs)
    assert {r.lang_pred for r in language_id.predict(odd_docs, empty).collect()} == {"und"}
    assert language_id.train(odd_docs.withColumn("lang", F.lit("a")).filter("text IS NULL")).languages == ["a"]


def test_known_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_KNOWN", 10)
    rows = [(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(k)), lang) for k, lang in ((40, "a"), (300, "b"))]
    model = language_id.train(spark.createDataFrame(rows, "text STRING, lang STRING"))
    assert len(model.words) <= 10 and len(model.runs) <= 40 and model.word_rows.shape[1] == 2


# Spelling


def plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(docs, shortest=7, least=2, loss=31, ratio=10):
    counts = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "[" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % loss == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    near = defaultdict(set)
    by_rest = defaultdict(set)  # near words share a word that lacks one code point of either
    for w in words:
        for rest in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_rest[rest].add(w)
    for some in by_rest.values():
        for a, b in combinations(some, 2):
            if plain_near(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(rows)


def found_variants(docs, **options):
    got = spelling.variants(docs, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r) for r in got.collect())


def test_variants_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.QUERIES["op12_spelling_variants"](spark, SF_DIR)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = plain_variants(docs)
    assert sorted(map(tuple, got.collect())) == wanted
    assert sum(r[4] > 0 for r in wanted) > 100 and any(r[1] for r in wanted)


def test_crowded_starts_are_cut_again(spark):
    rng = random.Random(5)
    words = {"abcdefg" + "".join(rng.choices("xy", k=rng.randint(0, 4))) for _ in range(60)}
    words |= {"".join(rng.choices("aÀ", k=7)) for _ in range(80)} | {"a" * 700 + c for c in "bcd"} | {"a" * 701, "a" * 350 + "z" + "a" * 350}
    words |= {"colours", "colurs", "colour", "coulour", "colouring", "colourings"}
    rows = [(i, f"{w}, {w.upper()} " * (1 + 20 * (i % 7 == 0))) for i, w in enumerate(sorted(words))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    wanted = plain_variants(rows, shortest=4)
    for most in (2, 1_000):
        assert found_variants(docs, shortest=4, most_sharing=most) == wanted
    assert any(r[1] and r[2] != r[1] for r in plain_variants([(1, "colours " * 200 + "coloursx " * 20 + "coloursxy " * 2)]))


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(1, 5), st.data())
def test_composed_machine_finds_each_pair_once(size, data):
    letters = st.sampled_from("abÀ")
    short = data.draw(st.sets(st.text(letters, min_size=size, max_size=size), max_size=20))
    long = data.draw(st.sets(st.text(letters, min_size=size + 1, max_size=size + 1), max_size=20))
    got = sorted(tuple(sorted(p)) for p in spelling.near_pairs(short, long, None))
    pairs = [*combinations(sorted(short), 2), *((a, b) for a in short for b in long)]
    assert got == sorted(tuple(sorted(p)) for p in pairs if plain_near(*p))


def test_equal_right_languages_are_one_state():
    machine = spelling.Acceptors()
    machine.add(["abx", "aby", "cbx", "cby"])
    assert len(machine.arcs) == 4 and sorted(machine.language(machine.add(["abx", "cbx"]))) == ["abx", "cbx"]


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found_variants(odd_docs.withColumn("word", F.lit(1)), shortest=3) == plain_variants(rows, shortest=3)
    assert found_variants(no_docs) == []
    long = "ab" * 1_000_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, long + "c"), (4, long + "c")], "doc_id BIGINT, text STRING")
    wanted = {len(long): 1, len(long) + 1: 1}
    assert {len(r[0]): r[4] for r in found_variants(docs, loss=10**9)} == wanted


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Rows (id, vector) coded by comparing every part with every entry."""
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    width = len(whole[0]) // parts
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    first = sorted((i for i, r in enumerate(rows) if r[0] is not None), key=lambda i: rows[i])[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min(range(len(book)), key=lambda e: (away(part, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for c in cut:
                of[nearest(c[p], books[p])].append(c[p])
            for e, some in of.items():
                books[p][e] = [sum(x) // len(some) for x in zip(*some)]
    codes = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(away(c[p], books[p][k[p]]) for p in range(parts)) for c, k in zip(cut, codes)]
    return ["".join(f"{e:02x}" for e in k) for k in codes], errors, books


SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


@pytest.mark.parametrize("spread", [0.001, 0.5, 3.0])
def test_codes_against_brute_force(spark, spread):
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 3, (5, 16))
    points = np.float32(np.round(centres[rng.integers(0, 5, 700)] + rng.normal(0, spread, (700, 16)), 3))
    points[::9] = points[0]  # copies, and so ties
    rows = [(int(i), p.tolist(), int(i) % 3) for i, p in zip(rng.permutation(700), points)]
    codes, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want, errors, plain = plain_codes([r[:2] for r in rows])
    got = {r.vec_id: (r.code, r.error, r.label) for r in codes.collect()}
    assert books.tolist() == plain
    assert got == {r[0]: (c, e, r[2]) for r, c, e in zip(rows, want, errors)}


@pytest.mark.parametrize("n,leaf", [(1, 16), (2, 1), (17, 16), (1000, 4), (333, 3)])
def test_trees_assign_every_row_once(n, leaf):
    rng = np.random.default_rng(n)
    for entries in (1, 2, 16):
        rows, book = rng.integers(-9, 9, (n, 3)), rng.integers(-9, 9, (entries, 3))
        bounds = vector_codes._levels(n, leaf)
        rows = rows[vector_codes.tree_order(rows, bounds)]
        tree = vector_codes.part_tree(rows, bounds, vector_codes.caches(rows, bounds))
        found = vector_codes.assign(tree, vector_codes.entry_tree(book))
        want = ((rows[:, None, :] - book) ** 2).sum(axis=2).argmin(axis=1)
        assert vector_codes.entry_of_rows(tree, found).tolist() == want.tolist()
        counts, sums = vector_codes.totals(tree, found, entries)
        assert counts.tolist() == np.bincount(want, minlength=entries).tolist()
        assert sums.tolist() == [rows[want == e].sum(axis=0).tolist() for e in range(entries)]


def test_whole_nodes_are_assigned_by_their_sums():
    rows = np.r_[np.zeros((512, 4), int), np.full((512, 4), 1000)]
    bounds = vector_codes._levels(1024)
    rows = rows[vector_codes.tree_order(rows, bounds)]
    tree = vector_codes.part_tree(rows, bounds, vector_codes.caches(rows, bounds))
    found = vector_codes.assign(tree, vector_codes.entry_tree(np.array([[1] * 4, [999] * 4])))
    assert not len(found.rows) and sum(len(n) for _, n, _ in found.nodes) == 2


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float((i * k) % 7 - 3) for k in range(8)], None if i % 2 else 4) for i in range(30)]
    odd = [
        (50, None, 1), (51, [], 1), (52, [1.0] * 7, 1), (53, [nan] * 8, 1), (54, [inf] * 8, 1), (55, [None] * 8, 1),
        (56, [1e30] * 8, 1), (57, [1.0] * 16, 1),
    ]
    rows = [*good, *odd, (None, [9.0] * 8, None), (3, good[3][1], 4)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("x"))
    codes, books = vector_codes.compress(frame)
    kept = [*good, *rows[-2:]]
    want, errors, plain = plain_codes([r[:2] for r in kept])
    found = vector_codes.with_label_errors(codes)
    sums = Counter()
    for r, e in zip(kept, errors):
        sums[r[2]] += e
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in found.select("vec_id", "label", "code", "error", "label_error").collect()), key=key)
    assert got == sorted(((r[0], r[2], c, e, sums[r[2]]) for r, c, e in zip(kept, want, errors)), key=key)
    assert books.tolist() == plain
    back = {r.code: r.vector for r in vector_codes.decoded(codes, books).collect()}
    for code, vector in back.items():
        assert vector == [x / 4096 for p in range(8) for x in plain[p][int(code[2 * p : 2 * p + 2], 16)]]
    empty, none = vector_codes.compress(frame.filter("vec_id = 50"))
    assert empty.count() == 0 and none.size == 0
    lone, none = vector_codes.compress(frame.filter("vec_id IS NULL"))
    assert [tuple(r) for r in lone.collect()] == [(None, None, None, None)] and none.size == 0
