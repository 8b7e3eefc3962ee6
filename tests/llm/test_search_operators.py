"""Token counts, hard negatives and ranked search against the library, brute force and SQL."""

import collections
import math
import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from candlewright.llm import multi_index, queries, ranked_search, token_counts

DATA = "/root/testdata/sf0.001"
CLASHES = ", n bigint, row bigint, id bigint, item int, rank int, part int, tokens string, pre_token string, g long, cell int"
NONE = (None,) * 10
LONG = " ".join(f"word{k % 7919}" for k in range(60_000))
TEXTS = [
    (1, "One clean line that ends here.\nAnd one more line of words."),
    (1, "One clean line that ends here.\nAnd one more line of words."),
    (2, None),
    (3, ""),
    (4, " \n\t \r\n "),
    (None, "A text without an id, but with words enough for every rule there is."),
    (None, None),
    (5, "x"),
    (6, LONG),
    (7, "▁ odd \U0001f600 marks  and   blanks \n that must survive </s> <unk>, all of them."),
    (8, "w" * 3000),
    (9, "ÀÉ Line LINE line, words\x00words"),
]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *NONE) for i, t in rows], "doc_id bigint, text string" + CLASHES)


# --- token counts ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def model():
    return token_counts.load_model(queries.PIECE_MODEL)


@pytest.mark.parametrize("head", [1 << 16, 40, 1])
def test_token_counts_are_the_librarys(spark, library, model, monkeypatch, head):
    monkeypatch.setattr(token_counts, "HEAD", head)
    given = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = TEXTS + [tuple(r) for r in given]
    got = token_counts.count_tokens(docs_of(spark, rows), model).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pre_tokens_cover_odd_texts(library, model, monkeypatch):
    pieces = ["a", "b", " ", "  ", "\n", "▁", "é", "\t", "the", "<s>", "</s>", "<0x0A>", "12", "日本", "\r", "\x00", "A."]
    own, rng = token_counts.Splitter(model), random.Random(1)
    for size in (1 << 20, 7):
        monkeypatch.setattr(token_counts, "SLICE", size)
        for _ in range(2000):
            text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 20)))
            found = own.frequencies(text)
            tokens = own.tokens(list(found))
            total = sum(n * t for n, t in zip(found.values(), tokens, strict=True))
            assert total == len(library.encode(text)), repr(text)


def test_every_pre_token_is_counted_once(spark, library, model):
    counts = token_counts.pre_token_counts(docs_of(spark, TEXTS), model).collect()
    keys = [r["pre_token"] for r in counts]
    assert len(keys) == len(set(keys))
    total = sum(r["n"] * r["tokens"] for r in counts)
    assert total == sum(len(library.encode(t or "")) for _, t in TEXTS)
    assert token_counts.digest(" " + "w" * 3000) in keys


def test_token_counts_of_no_rows(spark, model):
    empty = token_counts.count_tokens(docs_of(spark, []), model)
    assert empty.columns == ["id", "n_bytes", "n_tokens"] and empty.count() == 0


# --- hard negatives -------------------------------------------------------------------------


def brute_negatives(rows, is_anchor, params=multi_index.MineParams()):
    rows = list(dict.fromkeys((i, y, tuple(z)) for i, y, z in rows if i is not None and y is not None and z is not None))

    def product(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, y, z in rows:
        if not is_anchor(i):
            continue
        scored = sorted(((-product(z, w), j, u) for j, u, w in rows), key=lambda x: x[:2])
        positives = [(j, -s) for s, j, u in scored if u == y and j != i][: params.positives]
        for j, s in positives:
            inside = [(k, -t) for t, k, u in scored if u != y and params.low * s <= -100 * t <= params.high * s]
            out += [(i, j, r + 1, k, s, t) for r, (k, t) in enumerate(inside[: params.negatives])]
    return out


SMALL = multi_index.MineParams(rows_per_cell=6, first=16, growth=2, sample=100)


@pytest.mark.parametrize("params", [multi_index.MineParams(), SMALL])
def test_hard_negatives_against_all_rows(spark, params, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 7)
    monkeypatch.setattr(multi_index, "GROUP", 9)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 9)) * 20
    z = np.floor(centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 9)) * rng.choice([0, 1, 15], (600, 1)))
    rows = [(int(i), int(rng.integers(0, 4)), [int(x) for x in z[i]]) for i in range(600)]
    rows += rows[:3]  # repeats
    rows += [(700, None, [1, 2]), (None, 1, [1, 2]), (701, 1, None), (702, 1, []), (703, 2, [30, 5]), (20, 3, [9] * 9)]
    table = spark.createDataFrame([(*r, *NONE[1:]) for r in rows], "id bigint, label int, z array<bigint>" + CLASHES.replace(", id bigint", ""))
    got = multi_index.hard_negatives(table, F.col("id") % 20 == 0, params).collect()
    assert sorted(map(tuple, got)) == sorted(brute_negatives(rows, lambda i: i % 20 == 0, params))


def test_hard_negatives_beyond_exact_floats(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 2, [int(x) for x in rng.integers(-(1 << 30), 1 << 30, 3)]) for i in range(60)]
    table = spark.createDataFrame(rows, "id bigint, label int, z array<bigint>")
    got = multi_index.hard_negatives(table, F.col("id") % 5 == 0, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(brute_negatives(rows, lambda i: i % 5 == 0))


def test_hard_negatives_of_no_rows(spark):
    none = spark.createDataFrame([], "id bigint, label int, z array<bigint>")
    assert multi_index.hard_negatives(none, F.lit(True)).count() == 0
    one = spark.createDataFrame([(7, 1, [1, 2])], "id bigint, label int, z array<bigint>")
    assert multi_index.hard_negatives(one, F.lit(True)).count() == 0
    assert multi_index.hard_negatives(one, F.lit(False)).count() == 0


def test_unusable_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [([1.0, None],), ([nan],), ([inf],), ([-inf, 1.0],), (None,), ([0.5, -0.25],), ([],)]
    got = spark.createDataFrame(rows, "v array<float>").where(multi_index.usable(F.col("v")))
    whole = [r[0] for r in got.select(multi_index.whole_numbers(F.col("v"), 256)).collect()]
    assert sorted(whole) == [[], [128, -64]]


def test_cells_come_by_falling_bound():
    rng = np.random.default_rng(7)
    for n, m in [(1, 1), (1, 5), (6, 1), (7, 9)]:
        tops = rng.integers(0, 6, n).astype(float), rng.integers(0, 6, m).astype(float)
        cells = list(multi_index.cells_by_bound(tops))
        assert sorted((i, j) for _, i, j in cells) == [(i, j) for i in range(n) for j in range(m)]
        assert [b for b, _, _ in cells] == sorted((a + b for a in tops[0] for b in tops[1]), reverse=True)


def test_index_ends_early_where_it_can(spark):
    """Anchors beside close copies are certified without a visit to most cells."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 100
    z = np.floor(centres[np.arange(4000) % 40] + rng.normal(size=(4000, 16)))
    rows = [(i, i % 40, [int(x) for x in z[i]]) for i in range(4000)]
    table = spark.createDataFrame(rows, "id bigint, label bigint, z array<bigint>")
    params = multi_index.MineParams(rows_per_cell=10, first=64)
    directory = multi_index.build(table, params).directory()
    scores, tops, _ = directory.bounds(z[0])
    fifth = np.sort(z @ z[0])[-6]
    visited = sum(int(directory.rows[i * len(directory.codes[1]) + j]) for b, i, j in multi_index.cells_by_bound(tops) if b >= fifth)
    assert visited < 2000


# --- ranked search --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(rows, items):
    found = [(i, collections.Counter(terms(t))) for i, t in rows]
    found = [(i, c) for i, c in found if c]
    n, length = len(found), sum(c.total() for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 25 + (75 * c.total() * n) // length
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scored[:10])]
    return out


ITEMS = [
    (1, "words of a line, words of a line"),
    (2, "words of a LINE more words"),
    (3, None),
    (4, "-- ;"),
    (5, "ÀÉ àé nowhere"),
    (6, "of a line word1 word2 word3 word77"),
    (7, "of a line word1 word2 word3 word77 one more"),
    (None, "clean words"),
]


@pytest.mark.parametrize("cells, block", [(1 << 22, 1 << 10), (20, 3)])
def test_ranked_search_against_all_documents(spark, monkeypatch, cells, block):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", block)
    rng = random.Random(3)
    rows = TEXTS + [(100 + k % 50, " ".join(rng.choice(LONG.split()[:30] + ["words", "line", "of"]) for _ in range(rng.randint(1, 30)))) for k in range(120)]
    items = spark.createDataFrame([(i, t, *NONE) for i, t in ITEMS], "item_id bigint, text string" + CLASHES)
    got = ranked_search.search(docs_of(spark, rows), items).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_search(rows, ITEMS), key=str)


def test_shared_sums_give_every_item(spark):
    rng = random.Random(4)
    pool = [f"t{k}".encode() for k in range(60)]
    items = [collections.Counter(rng.choices(pool[:20], k=12) + rng.choices(pool, k=6)) for _ in range(40)] + [collections.Counter()]
    shared = ranked_search.share(items)
    sums = [collections.Counter() for _ in range(shared.nodes)]
    for term, node in zip(shared.terms, shared.node_of, strict=True):
        sums[node][term] += 1
    for added in shared.rounds:
        for node, a, b in added:
            assert a < node and b < node
            sums[node] = sums[a] + sums[b]
    for item, parts in zip(items, shared.items, strict=True):
        total = collections.Counter()
        for node, times in parts:
            for term, n in sums[node].items():
                total[term] += n * times
        assert total == item
    assert shared.additions < sum(len(x) for x in items)


def test_terms_in_slices(monkeypatch):
    whole = [w.encode() for w in terms(LONG)]
    monkeypatch.setattr(ranked_search, "SLICE", 1000)
    assert [w for part in ranked_search.terms(LONG.encode()) for w in part] == whole


def test_ranked_search_of_no_rows(spark):
    docs, items = docs_of(spark, TEXTS), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for got in (
        ranked_search.search(docs.limit(0), items),
        ranked_search.search(docs, items.limit(0)),
        ranked_search.search(docs.where("text is null"), items),
    ):
        assert got.columns == ["item", "rank", "id", "score"] and got.count() == 0
