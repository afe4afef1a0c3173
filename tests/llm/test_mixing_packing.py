import hashlib
import re
from collections import Counter, defaultdict

import pytest

from surestar.llm import mixing, packing, simhash_dedup
from surestar.llm.common import store
from surestar.llm.queries import SQL, QUERIES, sized_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights, share, most):
    """Targets by sharing the excess again until none is above its stop."""
    fixed, free = {}, dict(sizes)
    budget = share * sum(sizes.values())
    while free:
        rest = budget - sum(fixed.values())
        ratio = rest / sum(weights[s] for s in free)
        above = [s for s in free if ratio * weights[s] > most * sizes[s]]
        if not above:
            return {**fixed, **{s: ratio * weights[s] for s in free}}
        for s in above:
            fixed[s] = most * sizes[s]
            del free[s]
    return fixed


def brute_mix(rows, share=1.5, most=2.0, weights=(5, 2, 1)):
    sized = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    sizes = Counter()
    for _, s, n in sized:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = shares(sizes, {s: weights[k % len(weights)] for k, s in enumerate(order)}, share, most)
    key = lambda i: int(hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()[:15], 16)
    out = []
    for s in order:
        words = int(target[s] + 0.5)
        epochs, left = divmod(words, sizes[s]) if sizes[s] else (0, 0)
        for i, _, n in sorted((r for r in sized if r[1] == s), key=lambda r: (key(r[0]), r[2])):
            more = min(n, left)
            left -= more
            out.append((i, n, sizes[s], epochs * n + more))
    return out, target


def mix(docs):
    rows = store(sized_documents(docs.select("doc_id", "source", "text")).drop("text"))
    return mixing.take(rows, mixing.cuts(rows))


def test_mix_equals_brute_force(docs, documents, no_docs):
    out = mix(docs).collect()
    want, target = brute_mix([(r[0], r[1], r[3]) for r in documents])
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r["size"], r.source_size, r.taken) for r in out), key=key) == sorted(want, key=key)
    assert all(abs(r.target - target[r.source]) < 1e-9 * max(1, r.target) for r in out)
    assert sum(r.taken for r in out) == sum(int(t + 0.5) for t in target.values())
    assert mix(no_docs).count() == 0


def test_many_rows_of_one_key_are_cut_exactly(spark):
    rows = [(1, "a b c", "hot")] * 100 + [(2, "a b", "cold")] * 5 + [(3, "", "none")]
    out = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want, _ = brute_mix(rows)
    assert sorted((r.doc_id, r["size"], r.source_size, r.taken) for r in out) == sorted(want)


def test_only_empty_texts(spark):
    out = mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r.taken, r.target) for r in out) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_copies_write_the_mix_out(docs):
    sized = sized_documents(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    rows = store(sized.select("doc_id", "source", "key", "size"))
    written = mixing.copies(mixing.take(sized, mixing.cuts(rows))).collect()
    words = Counter()
    for r in written:
        words[r.source] += len(WORD.findall(r.text))
        assert r.text
    taken = Counter()
    for r in mix(docs).collect():
        taken[r.source] += r.taken
    assert words == +taken


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, folder, name):
    from surestar.queries.base import Query
    from tests.oracle import compare

    assert compare(spark, folder, Query(QUERIES[name], SQL[name])) == []


def naive_pack(sizes, sources, clusters, capacity, per_source):
    """Best fit by looking at every bin; of bins with equal room the one that got it last."""
    bins, out, clock = [], [], 0
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [b for b in bins if b["room"] >= size and b["room"] > 0 and b["sources"][s] < per_source and c not in b["clusters"]]
        if fits:
            b = min(fits, key=lambda b: (b["room"], -b["time"]))
        else:
            b = {"room": capacity, "sources": Counter(), "clusters": set(), "n": len(bins)}
            bins.append(b)
        clock += 1
        b["room"] -= size
        b["time"] = clock
        b["sources"][s] += 1
        b["clusters"].add(c)
        out.append(b["n"])
    return out


def test_pack_pieces_is_best_fit():
    import random

    rng = random.Random(4)
    for per_source in (1, 2, 50):
        for _ in range(25):
            n = rng.randint(1, 120)
            sizes = sorted((rng.choice([rng.randint(1, 40), 13]) for _ in range(n)), reverse=True)
            sources = [rng.choice("aaabcde") for _ in range(n)]
            clusters = [rng.choice([1, 1, 1, 2, *range(3, 60)]) for _ in range(n)]
            got = packing.pack_pieces(sizes, sources, clusters, 40, per_source)
            assert got == naive_pack(sizes, sources, clusters, 40, per_source)


def check_packing(rows, out, capacity, per_source):
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id, r.source].append((r.start_word, r.n_words))
    want = defaultdict(list)
    for i, text, source in rows:
        n = len(WORD.findall(text or ""))
        want[i, source] += [(a, min(capacity, n - a)) for a in range(0, n, capacity)] or [(0, 0)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    bins = defaultdict(list)
    for r in out:
        assert (r.bin_id is None) == (r.n_words == 0)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for own in bins.values():
        assert sum(r.n_words for r in own) == own[0].bin_words <= capacity
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert max(Counter(r.source for r in own).values()) <= per_source
    return bins


def test_pack_documents(docs, documents, no_docs):
    rows = [(r[0], r[1], r[3]) for r in documents]
    bins = check_packing(rows, packing.pack(docs, 16).collect(), 16, 1)
    assert check_packing(rows, packing.pack(docs, 16, 2).collect(), 16, 2)
    both = [{r.doc_id for r in own} for own in bins.values()]
    assert {1, 2} not in both  # copies but for case and white space
    assert packing.pack(no_docs).count() == 0


def test_copies_of_a_long_document_fill_bins_of_their_own(spark):
    rows = [(1, "w " * 10, "a")] * 3 + [(2, "v " * 4, "b")]
    check_packing(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), 4).collect(), 4, 1)


def test_pack_query(spark, folder):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_packing(rows, QUERIES["op3_packing"](spark, folder).collect(), 2048, 1)


def test_near_copies_never_share_a_sequence(spark, tmp_path):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join([*words[:at], "changed", *words[at + 1 :]]) for at in (50, 200, 399)] + [" ".join(words)]
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)] + [(9, " ".join(f"v{i}" for i in range(300)), "other"), (10, "", "a"), (None, texts[0], "b")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(path)
    found = simhash_dedup.near_duplicates(spark.read.parquet(path)).collect()
    root = {r.doc_id: r.root for r in found}
    assert len({root[i] for i in (0, 1, 2, 3, None)}) == 1 and root[9] != root[0]
    bins = check_packing(rows, QUERIES["op3_packing"](spark, str(tmp_path)).collect(), 2048, 1)
    assert all(max(Counter(root[r.doc_id] for r in own).values()) == 1 for own in bins.values())


def test_full_pieces_of_a_cluster_have_sequences_of_their_own(spark):
    rows = [(5, "w " * 9, "a", 1), (5, "w " * 13, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, root long")
    check_packing([r[:3] for r in rows], packing.pack(df, 4, cluster=df.root).collect(), 4, 1)
