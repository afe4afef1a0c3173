"""Alignment against a version that goes token by token with the plain tokenizers."""

import hashlib
from collections import Counter

import pytest

from surestar.llm import alignment
from surestar.llm.queries import TOKENIZERS

FILES = (f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def spans(tokens):
    at, out = 0, []
    for i, token in tokens:
        out.append((i, at, at + len(token)))
        at += len(token)
    return out


def brute(texts, tokenizers):
    a_model, b_model = tokenizers
    vocabulary = alignment.byte_level_tokens(open(FILES[0], encoding="utf-8").read())
    pieces = alignment.piece_tokens(b_model)
    docs = []
    for text in texts:
        whole = " " + (text or "")
        a = [(i, vocabulary[i]) for i in a_model.encode(whole, add_special_tokens=False).ids]
        b = [(i, pieces[i]) for i in b_model.encode(text or "")]
        if not text or any(b"".join(t for _, t in x) != whole.encode() for x in (a, b)):
            docs.append(None)
            continue
        a, b = spans(a), spans(b)
        cuts = {e for _, _, e in a} & {e for _, _, e in b}
        groups, low = [], 0
        for cut in sorted(cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in x if low <= s and e <= cut) for x in (a, b)))
            low = cut
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for d in docs if d for pair in set(d[3]))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = d
        n_best = sum(counts[x] == best[x[0]] for x in links)
        out.append((n_a, n_b, n_groups, len(links), n_best, sum(counts[x] for x in links), digest))
    return out


TEXTS = [
    "The quick brown fox", "the quick brown fox", "", None, "a  b\t\tc\n\n d ", "<|endoftext|> is text <s> too </s>", "été 😀 naïve ﬁ ²",
    "under▁score", "日本語のテキスト", "The quick brown fox", "don't can't we'll 1234567 3.14", " ", "\n", "x" * 300, " " * 700 + "y", "</s>",
    "ÀÉÎ õü ĀēŐ", " hard­soft",
]


@pytest.mark.parametrize("head", [0, 3, 10**6])
def test_like_token_by_token(spark, tokenizers, head):
    rows = [(i if i != 9 else 0, text, "clash", 1) for i, text in enumerate(TEXTS)] + [(None, "the fox", "clash", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string, row int").repartition(3)
    got = alignment.align_documents(df, *FILES, head=head).collect()
    wanted = brute([text for _, text, _, _ in rows], tokenizers)
    named = sorted(str((r[0], *x)) for r, x in zip(rows, wanted, strict=True))
    assert sorted(str((r.doc_id, *(r[c] for c in COLUMNS))) for r in got) == named


def test_quick_tokens_are_those_of_the_file(tokenizers, documents):
    encoders = alignment._encoders(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())
    texts = [" " + (t or "") for _, t, *_ in documents] + ["a" * 40_000, " " * 40_000, "\n\n  \n" * 5000, "x.!? " * 9000, "ab 1" * 12_000]
    assert encoders.encode_a(texts) == [tokenizers[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_very_long_texts_and_slices(spark, tokenizers, monkeypatch):
    texts = [" " * 1_000_000, "a" * 1_000_000, "word " * 300_000, "short one"]
    encoders = alignment._encoders(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())
    table = alignment.align_texts(texts, encoders).to_pylist()
    for text, row in zip(texts, table, strict=True):
        assert row["n_a"] == len(tokenizers[0].encode(" " + text, add_special_tokens=False).ids)
        assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"] == sum(row["times"])
    alone = alignment.align_texts(texts[3:], encoders).to_pylist()[0]
    assert alone == table[3]


def test_no_documents(spark, no_docs):
    assert alignment.align_documents(no_docs, *FILES).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    got = alignment.align_documents(nothing, *FILES).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
