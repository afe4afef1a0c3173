import numpy as np
import pytest

from surestar.llm import token_files as tf
from surestar.llm.queries import QUERIES, TOKENIZERS

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def brute(tokens, separator=tf.SEPARATOR):
    lengths, at = [], 0
    for t in tokens:
        if t == separator:
            lengths.append(at)
            at = 0
        else:
            at += 1
    return lengths + ([at] if at else [])


def encoding():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("t", pat_str=tf.PATTERN, mergeable_ranks=tf.load_ranks(VOCABULARY), special_tokens={})


@pytest.mark.parametrize("block_tokens", [1, 2, 3, 7, 1000])
def test_scan_equals_brute_force(spark, tmp_path, block_tokens):
    rng = np.random.default_rng(block_tokens)
    files = {
        "a": rng.choice([1, 2, tf.SEPARATOR], 50), "b": np.full(20, 5), "c": np.full(6, tf.SEPARATOR), "d": np.array([], int),
        "e": np.concatenate([np.full(40, 3), [tf.SEPARATOR], np.full(3, 3), [tf.SEPARATOR]]), "f": np.array([tf.SEPARATOR]), "g": np.array([7]),
    }
    for name, tokens in files.items():
        tokens.astype("<u2").tofile(tmp_path / f"{name}.bin")
    (tmp_path / "other.txt").write_text("not a token file")
    out = {}
    for r in tf.scan(spark, str(tmp_path), block_tokens=block_tokens).orderBy("file", "place").collect():
        out.setdefault(r.file[0], []).append((r.place, r.n_tokens))
    assert out == {k: list(enumerate(brute(v))) for k, v in files.items() if len(v)}


def test_wide_identifiers_and_odd_lengths(spark, tmp_path):
    np.array([70000, 99, 70000, 1, 2, 99], "<u4").tofile(tmp_path / "a.bin")
    assert [r.n_tokens for r in tf.scan(spark, str(tmp_path), 99, 4, 2).orderBy("place").collect()] == [1, 3]
    (tmp_path / "b.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="not a whole number"):
        tf.scan(spark, str(tmp_path), 99, 4, 2).collect()


def test_counts_of_documents(docs, documents, no_docs):
    encoder = encoding()
    out = sorted(((r.doc_id, r.n_tokens) for r in tf.token_counts(docs, VOCABULARY).collect()), key=str)
    assert out == sorted(((r[0], len(encoder.encode_ordinary(r[1] or ""))) for r in documents), key=str)
    assert tf.token_counts(no_docs, VOCABULARY).count() == 0


def test_text_of_the_separator_is_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a<|endoftext|>b"), (2, "c")], "doc_id long, text string")
    assert sorted(tuple(r) for r in tf.token_counts(df, VOCABULARY).collect())[1] == (2, 1)


def test_query(spark, folder):
    encoder = encoding()
    want = {r.doc_id: len(encoder.encode_ordinary(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op9_token_counts"](spark, folder).collect()} == want


def test_merges_of_long_pieces():
    encoder, ranks = encoding(), tf.load_ranks(VOCABULARY)
    rng = np.random.default_rng(3)
    pieces = [" " * 900, "\n" * 801, "a" * 700, "".join(rng.choice(list("abcdefghe"), 900)), " " + "ж" * 400, "=" * 600, "0" * 512, "日本語" * 200]
    for piece in pieces:
        assert tf.merge_piece(piece.encode(), ranks) == encoder.encode_ordinary(piece)


@pytest.mark.parametrize("run", [" ", "\n", " ", "x", "ab1", "it's", "日本", "\x1c"])
def test_long_runs_inside_texts(monkeypatch, run):
    encoder, ranks = encoding(), tf.load_ranks(VOCABULARY)
    monkeypatch.setattr(tf, "LONG_RUN", 16)
    space = tf.SPACE
    monkeypatch.setattr(tf, "_LONG", tf.re.compile(rf"(?<![{space}])[{space}]{{16,}}|(?<![^{space}])[^{space}]{{16,}}"))
    for text in (run * 40, f"a {run * 40}", f"{run * 40} b", f"word's{run * 40}end", f"a\n\n{run * 40}\t c", f"a{' ' * 30}{run * 40}{' ' * 30}it's"):
        assert tf.encode_text(encoder, ranks, text) == encoder.encode_ordinary(text)


def test_texts_with_millions_of_one_character(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id long, kind int").selectExpr(
        "doc_id", "concat('start', repeat(elt(kind + 1, ' ', '\\n', 'a'), 5000000), 'end.') AS text"
    )
    out = {r.doc_id: r.n_tokens for r in tf.token_counts(df, VOCABULARY).collect()}
    encoder = encoding()
    one = lambda c, n: len(encoder.encode_ordinary(f"start{c * n}end."))
    for doc_id, c in ((1, " "), (2, "\n")):  # the count grows by the same number of tokens per period of a run
        step = one(c, 24000) - one(c, 12000)
        assert out[doc_id] > 0 and abs(out[doc_id] - 5_000_000 * step / 12000) < 50
    assert 5_000_000 / 128 < out[3] < 5_000_000


def test_blocks_are_ranges_of_a_sparse_file_above_two_gigabytes(spark, tmp_path):
    size = (1 << 31) + (1 << 20)
    with open(tmp_path / "a.bin", "wb") as out:
        for at in (10, 1 << 30, size - 2):
            out.seek(at)
            out.write(np.array([tf.SEPARATOR], "<u2").tobytes())
    got = [r.n_tokens for r in tf.scan(spark, str(tmp_path), block_tokens=1 << 24).orderBy("place").collect()]
    assert got == [5, (1 << 29) - 6, (size - 2) // 2 - (1 << 29) - 1]
