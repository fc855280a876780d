import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm import packing, tokenfile
from quillspark.llm.tokens import UnitEncoder

SF = "/root/testdata/sf0.01"
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    out = {}
    for name in FILES:
        t = out[name] = Tokenizer.from_file(public_tokenizers.path(name))
        t.encode_special_tokens = True
    return out


ODD = ["", " ", "  ", "a   b", "a\n\n\nb  \n c", "a\tb", "x\x1cy !\x1cz", "<|endoftext|> a", "don't 'll", "é İI ΑΣ",
       "a.\n\nB, c;d", "ßŒÿ Ħ 日本\n語", "9 12a", "...!? --"]


@pytest.mark.parametrize("name", FILES)
def test_units_give_the_ids_of_the_whole_text(whole, sf_docs, name):
    own = UnitEncoder(public_tokenizers.path(name))
    for text in ODD + [sf_docs[d] for d in range(150)]:
        want = np.array(whole[name].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.encode(text) == want, text[:80]


@pytest.fixture(scope="module")
def fresh():
    """Encoders that forget: emptied before each text, loaded once."""
    return {name: UnitEncoder(public_tokenizers.path(name)) for name in FILES}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sA .,\n\t é9!日$")), max_size=30))
def test_units_of_random_texts(whole, fresh, text):
    for name in FILES:
        own = fresh[name]
        own.clear()
        assert own.encode(text) == np.array(whole[name].encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 49_407), st.integers(0, 2**64 - 1)), max_size=300),
       st.integers(0, 9000))
def test_simple8b_round_trip(ids, zeros):
    a = np.array(ids + [0] * zeros, np.uint64)
    words, first = tokenfile.simple8b_encode(a)
    assert np.array_equal(tokenfile.simple8b_decode(words), a)
    seg = tokenfile.Segment(tokenfile.encode_segment([None], [a]))
    lo, hi = len(a) // 3, len(a) - len(a) // 4
    assert np.array_equal(seg.ids(lo, hi), a[lo:hi]) and seg.doc_ids == [None]


def test_token_files_query(spark, whole, sf_docs):
    from quillspark.llm.queries import queries
    got = {r.doc_id: tuple(r) for r in queries()["op6_token_files"](spark, SF).collect()}
    at = 0
    for d in sorted(sf_docs):
        ids = np.array(whole["word_bpe_49k.json"].encode(sf_docs[d], add_special_tokens=False).ids + [1], "<u4")
        assert got[d] == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(sf_docs)


def test_packing_query(spark, whole, sf_docs):
    from quillspark.llm.queries import queries
    rows = queries()["op4_packing"](spark, SF).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, text in sf_docs.items():
        ids = np.array(whole["byte_bpe_50k.json"].encode(text, add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(by_doc[d], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(-(-len(ids) // 2048)))
        assert [p.length for p in parts[1:]] == [2048] * (len(parts) - 1)
        at = 0
        for p in parts:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for members in by_seq.values():
        members.sort(key=lambda r: r.offset)
        assert [m.offset for m in members] == np.cumsum([0] + [m.length for m in members])[:-1].tolist()
        assert sum(m.length for m in members) <= 2048
    assert len(by_seq) <= packing.lower_bound([r.length for r in rows], 2048) + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40))
def test_pack_is_a_packing_and_no_worse_than_best_fit(sizes):
    got = packing.pack(sizes, 40)
    assert sorted(s for b in got for s in b) == sorted(sizes) and all(sum(b) <= 40 for b in got)
    assert len(got) <= len(packing.best_fit_decreasing(sizes, 40))


def test_bin_completion_beats_best_fit():
    sizes = [6, 5, 5, 4, 4, 3, 3] + [7, 3, 7, 3, 5, 5, 6, 4]  # sums to 70
    assert len(packing.pack([51, 27, 22, 50, 26, 24, 49, 28, 23, 35, 33, 32], 100)) == 4
    assert len(packing.pack(sizes, 10)) == 7


def test_edges(spark, docs_of):
    rows = [(2, None), (2, ""), (None, "alpha"), (None, "alpha"), (1, "beta gamma")]
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(docs_of(rows), path).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "None", "None"]
    assert [r.length for r in got if r.doc_id == 2] == [1, 1]
    assert len({r.sequence_id for r in got}) == 1
    files = tokenfile.token_files(docs_of(rows), public_tokenizers.path("word_bpe_49k.json")).collect()
    assert [r.doc_id for r in sorted(files, key=lambda r: r.start)] == [None, None, 1, 2, 2]
    assert packing.pack_documents(docs_of(rows).filter("false"), path).count() == 0
    assert tokenfile.token_files(docs_of(rows).filter("false"), path).count() == 0


@pytest.mark.parametrize("name", FILES)
def test_units_that_hold_special_strings_and_generations(whole, sf_docs, name):
    """Marks inside a text are ordinary text; what an emptied generation forgot is learnt again."""
    own = UnitEncoder(public_tokenizers.path(name), limit=60)
    odd = ["a <|endoftext|> b<|endoftext|>c", "x<|startoftext|>y z", "<|endoftext|>", "q" * 500 + " tail", "<|endoftext| ><|"]
    for text in (odd + [sf_docs[d] for d in range(25)]) * 2:
        assert own.encode(text) == np.array(whole[name].encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:60]
        assert len(own) <= 30 and not any(len(u) > 200 for u in own)


def test_bytes_that_are_not_utf8_count_as_replacement_characters(spark, whole):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, bytearray(b"ab \xff cd")), (2, bytearray(b"\x80"))], "doc_id long, b binary")
    df = df.select("doc_id", F.col("b").cast("string").alias("text"))
    texts = {1: "ab \ufffd cd", 2: "\ufffd"}
    got = packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    files = tokenfile.token_files(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    for rows, name, end in ((got, "byte_bpe_50k.json", 0), (files, "word_bpe_49k.json", 1)):
        want = {d: zlib.crc32(np.array(whole[name].encode(t, add_special_tokens=False).ids + [end], "<u4").tobytes()) for d, t in texts.items()}
        assert {r.doc_id: r.ids_crc32 for r in rows} == want


def test_rows_of_one_id_fill_several_files(spark):
    rows = [(None, f"alpha {i}") for i in range(900)] + [(5, f"beta {i}") for i in range(900)] + [(9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = public_tokenizers.path("word_bpe_49k.json")
    from quillspark.session import scratch_path
    folder = scratch_path(spark, "test-files")
    tokenfile.write_token_files(df, path, folder)
    sizes = [r[1] for r in spark.read.parquet(folder).groupBy("file_no").sum("n_ids").collect()]
    got = tokenfile.read_token_files(spark, folder).collect()
    assert len(sizes) > 2 and max(sizes) < 0.6 * sum(sizes)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == [None] * 900 + [5] * 900 + [9]


def test_a_very_long_text(spark, whole):
    text = " ".join(f"word{i % 7000} $$$,%% ünïcode" for i in range(60_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ids = whole["byte_bpe_50k.json"].encode(text, add_special_tokens=False).ids
    rows = packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sum(r.length for r in rows) == len(ids) + 1
    back = tokenfile.token_files(df, public_tokenizers.path("word_bpe_49k.json")).first()
    want = whole["word_bpe_49k.json"].encode(text, add_special_tokens=False).ids + [1]
    assert (back.n_tokens, back.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))


def test_ranges_keep_the_order_of_ids_and_spread_equal_ones():
    rng = np.random.default_rng(1)
    cuts = np.array([3, 3, 3, 8, 20])
    ids = np.concatenate([np.full(400, 3), rng.integers(-5, 30, 300)])
    part = tokenfile.range_of(ids, cuts, 7)
    order = np.lexsort((ids, part))
    assert (np.diff(ids[order]) >= 0).all() and part.min() == 0 and part.max() == 5
    assert np.bincount(part[ids == 3], minlength=4)[:4].min() >= 100
    assert tokenfile.range_of(ids, np.array([], np.int64), 0).max() == 0
