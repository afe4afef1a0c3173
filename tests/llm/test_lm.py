import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from surestar.llm import lm
from surestar.llm.queries import QUERIES


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def check_base(out, rows, trained):
    counts = Counter(w for i, t in rows if trained(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        words = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want[i, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want


def test_odd_rows(spark, docs, documents, no_docs):
    rows = [(r[0], r[1]) for r in documents]
    for trained in (lambda i: i in (1, 5, 7, 13), lambda i: False, lambda i: True):
        ids = [i for i, _ in rows if i is not None and trained(i)]
        chosen = F.col("doc_id").isin(ids) | (F.col("doc_id").isNull() if trained(None) else F.lit(False))
        out = lm.score_texts(docs, F.coalesce(chosen, F.lit(False)), frequent=5).collect()
        check_base(out, rows, trained)
        assert all(math.isfinite(r.score) and r.score <= 0 for r in out)
    assert lm.score_texts(no_docs, F.lit(True)).count() == 0


def test_looking_words_up_changes_little(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trained = F.col("doc_id") % 3 != 0
    all_known = {r.doc_id: r for r in lm.score_texts(docs, trained, 10**6).collect()}
    for r in lm.score_texts(docs, trained, 200).collect():
        assert r.n_known == all_known[r.doc_id].n_known and abs(r.base_score - all_known[r.doc_id].base_score) < 1e-6
        assert abs(r.score / all_known[r.doc_id].score - 1) < 0.2


def trained(texts):
    counts = np.zeros(lm.CELLS, np.int64)
    lm.count_cells(texts, counts)
    return counts, lm.odds_tables(counts)


def lines(*texts):
    return [lm.normalised(t)[1] for t in texts]


def test_it_is_a_probability_and_learns():
    rng = np.random.default_rng(0)
    parts = [b"ka", b"lu", b"mo", b"zi", b"xe"]
    words = sorted({b"".join(parts[k] for k in rng.integers(0, 5, rng.integers(2, 6))) for _ in range(900)})
    train, held = lines(*words[::2]), lines(*words[1::2])
    _, tables = trained(train)
    ways = lm.paths(tables)
    assert -lm.log10_scores(ways, held).mean() < -lm.log10_scores(ways, [w[-2::-1] + b"\n" for w in held]).mean() - 1
    one_byte = lm.log10_scores(ways, [bytes([b]) for b in range(256)])
    assert abs((10.0**one_byte).sum() - 1) < 1e-4


def by_bit(tables, text):
    """The mixer, bit by bit: contexts from slices of the window, cells from whole numbers, a weight per context and place of the bit."""
    mask = (1 << 32) - 1
    ends = {32 << i for i in range(11)}
    weights, bias = [[lm.START] * 8 for _ in range(lm.KINDS)], [0.0] * 8
    push, errors, spread, total = [[0.0] * 8 for _ in range(lm.KINDS)], [0.0] * 8, [0.0] * 8, 0.0
    a, b, c = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35
    seen, run = {}, 0
    for at, byte in enumerate(text):
        place = at % lm.WINDOW
        if place == 0:
            seen, run = {}, 0
            if at:
                weights, bias, push, errors = moved(weights, bias, push, errors, spread)
        back = [text[at - j] if place >= j else 0 for j in range(1, 7)]
        four = sum(x << 8 * j for j, x in enumerate(back[:4]))
        five = (four * a * c + back[4] * b) & mask
        known = seen.get(five)
        guess = 0 if known is None else 1 + known + 256 * min(run, 15)
        run = run + 1 if known == byte else 0
        seen[five] = byte
        rows = []
        for k, context in enumerate((four & 0xFFFF, four, (five * c + back[5] * b) & mask, guess)):
            h = context * a & mask
            h = (h ^ h >> 15) * b & mask
            low = h ^ ((byte >> 4) + 1) * c & mask
            low = (low ^ low >> 13) * a & mask
            shift = 32 - lm.GROUP_BITS[k]
            rows.append([tables[k][h >> shift], tables[k][low >> shift]])
        for j in range(8):
            half = byte >> 4 if j < 4 else byte & 15
            node = (1 << j % 4) | (half >> (4 - j % 4))
            bit = byte >> (7 - j) & 1
            x = [float(r[j // 4][node]) / lm.STEPS for r in rows]
            odds = bias[j] + sum(w[j] * v for w, v in zip(weights, x, strict=True))
            odds = max(-lm.BOUND, min(lm.BOUND, odds))
            p = 1 / (1 + math.exp(-odds))
            total += math.log10(p if bit else 1 - p)
            for k in range(lm.KINDS):
                push[k][j] += (bit - p) * x[k]
            errors[j] += bit - p
            spread[j] += p * (1 - p)
        if at + 1 in ends:
            weights, bias, push, errors = moved(weights, bias, push, errors, spread)
    return total


def moved(weights, bias, push, errors, spread):
    rate = [1 / (lm.PRIOR + lm.CURVE * s) for s in spread]
    new = [[w[j] + rate[j] * g[j] for j in range(8)] for w, g in zip(weights, push, strict=True)]
    return new, [bias[j] + rate[j] * errors[j] for j in range(8)], [[0.0] * 8 for _ in weights], [0.0] * 8


def test_scores_are_those_of_the_bits_one_by_one(spark):
    texts = [r.text.encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").limit(60).collect()]
    coded = lines(*texts)
    _, tables = trained(coded[:40])
    some = [*coded[35:50], b"\n", coded[3][:700] * 110 + b"\n", b"a\n", "é 😀\n".encode()]
    assert len(some[16]) > lm.WINDOW
    got = lm.log10_scores(lm.paths(tables), some)
    assert np.allclose(got, [by_bit(tables, t) for t in some], rtol=2e-4, atol=1e-3)


def test_cells_hold_the_bits_of_each_context():
    texts = lines(b"abab abba", b"ba ab", b"")
    counts, _ = trained(texts)
    assert counts.sum() == 2 * lm.KINDS * sum(map(len, texts))
    after = Counter()
    for t in texts:
        for at, byte in enumerate(t):
            after[t[max(0, at - 2) : at], byte] += 1
    leaves = counts[: lm.OFFSETS[1]]
    lower = [n for n in leaves.tolist() if n]
    assert max(lower) <= sum(map(len, texts)) and lm.node_counts(leaves.reshape(-1, 16))[:, :, 1].sum() == leaves.sum()
    for (before, byte), n in after.items():
        context = np.array([sum(x << 8 * j for j, x in enumerate(before[::-1]))], np.uint32)
        _, low = lm.cells(0, context, lm.halves(np.array([byte], np.uint8)))
        assert leaves[low[0]] >= n


def test_gate_weights_balance_the_counted_bits():
    rng = np.random.default_rng(5)
    share = rng.beta(0.3, 0.3, 5000)
    n = rng.integers(1, 40, 5000)
    ones = rng.binomial(n, share).astype(np.float32)
    zeros = (n - ones).astype(np.float32)
    best = lm.gate_weights(zeros, ones, 30)

    def loss(weights):
        total = 0.0
        for count, fewer, sign in ((ones, (zeros, np.maximum(ones - 1, 0)), 1), (zeros, (np.maximum(zeros - 1, 0), ones), -1)):
            odds, gate = lm.log_odds(*fewer)
            total += (count * np.log1p(np.exp(-sign * weights[gate] * odds))).sum()
        return total

    for g in range(lm.GATES):
        for step in (-0.1, 0.1):
            other = best.copy()
            other[g] += step
            assert loss(other) >= loss(best) - 1e-3 * abs(loss(best))


def test_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op2_lm_score"](spark, folder).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    check_base(out, rows, lambda i: not held(i))
    assert all(r.held_out == held(r.doc_id) for r in out)


def test_batches_stay_small():
    texts = [b"x" * 150_000, b"y\n", b"z" * 300_000, *[b"w\n"] * 10]
    pieces = list(lm.cut(texts))
    assert all(sum(map(len, windows)) <= lm.BATCH and len(set(places)) == len(places) for places, windows in pieces)
    whole = {}
    for places, windows in pieces:
        for i, window in zip(places, windows, strict=True):
            whole[i] = whole.get(i, b"") + window
    assert [whole[i] for i in range(len(texts))] == texts


def test_memory_does_not_grow_with_a_text():
    """A text of ten megabytes needs little more than the text itself."""
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, 6, dtype=np.uint8)) for _ in range(500)]
    text = b" ".join(words[i] for i in rng.integers(0, 500, 1_450_000)) + b"\n"
    assert len(text) > 10_000_000
    _, tables = trained([text[:200_000]])
    ways = lm.paths(tables)
    tracemalloc.start()
    lm.log10_scores(ways, [text])
    lm.count_cells([text], np.zeros(lm.CELLS, np.int64))
    assert tracemalloc.get_traced_memory()[1] < 150 << 20
    tracemalloc.stop()


def test_word_order_reaches_the_bit_predictors(spark):
    rng = np.random.default_rng(3)
    names = [f"{a}{b}{c}" for a in "bdgk" for b in "aou" for c in ("lin", "mer", "tas")]
    follows = rng.permutation(len(names))

    def chain(at, n):
        words = []
        for _ in range(n):
            words.append(names[at])
            at = follows[at]
        return words

    rows = [(i, " ".join(chain(int(rng.integers(len(names))), 30))) for i in range(60)]
    for i in range(60, 80):
        words = chain(int(rng.integers(len(names))), 30)
        rows += [(i, " ".join(words)), (i + 100, " ".join(rng.permutation(words)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm.score_texts(df, F.col("doc_id") < 60).collect()}
    assert all(score[i] > 0.7 * score[i + 100] for i in range(60, 80))


def test_a_text_predicts_its_own_repeats(spark):
    rng = np.random.default_rng(4)
    new = lambda n: ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]
    rows = [(i, " ".join(new(20) * 2)) for i in range(40)]
    unseen = new(40)
    rows += [(100, " ".join(unseen + unseen)), (101, " ".join(unseen + new(40)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm.score_texts(df, F.col("doc_id") < 100).collect()}
    assert score[100] > 0.75 * score[101]


def test_scores_do_not_depend_on_the_broadcast(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    few, all_of_them = ({r.doc_id: r for r in lm.score_texts(docs, F.col("doc_id") % 3 != 0, n).collect()} for n in (5, 10**6))
    for i, r in few.items():
        assert r.n_known == all_of_them[i].n_known and math.isclose(r.base_score, all_of_them[i].base_score, rel_tol=1e-9)
        assert math.isclose(r.score, all_of_them[i].score, rel_tol=1e-6) and math.isclose(r.bits_per_byte, all_of_them[i].bits_per_byte, rel_tol=1e-6)


def test_a_text_scores_alike_in_any_batch():
    texts = lines(b"", b"one two three", b"ab " * 700 + b"c", b"one two three", "é 😀".encode(), b"one two three " * 9000)
    ways = lm.paths(trained(texts)[1])
    together = lm.log10_scores(ways, texts)
    alone = [lm.log10_scores(ways, [t])[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-5) and np.isclose(together[1], together[3], rtol=1e-6)


def test_words_in_arrow_are_those_of_python(monkeypatch):
    texts = [b"", b" \t\x0b\x0c\r\n", b"b A  a\x1cb\xc2\xa0c", b"\xff\xfe x \xc3", "Ñu ñu".encode(), b"x " * 50]
    tokens, lines = zip(*map(lm.normalised, texts), strict=True)
    words, long = lm.words_of(list(lines))
    assert words.to_pylist() == [w for t in tokens for w in t] and long.tolist() == list(map(len, tokens))
    monkeypatch.setattr(lm, "PIECE", 8)
    cut = list(lm.pieces(list(lines)))
    assert len(cut) > 2 and [x for part in cut for x in part] == list(lines) and not list(lm.pieces([]))
