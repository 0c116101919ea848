"""Token ids, packing and record files against the tokenizer library itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brassledger.llm import packing, token_records
from brassledger.llm.tokens import Encoder
from brassledger.session import shared_folder, ship_package

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Plain words, and more. Plain words,", "", None, "  two  spaces\n\nand lines \t tab ", "don't we're 12.5 a.b.c x,y",
    "Éç qui une été.\nÜber çà", "\n", "a", "the " * 6000 + "end", "日本語 テキスト。", "x y z\x1cw", "same", "same", "<|endoftext|> ,. ...", "a <|endoftext|> b", "word <|endoftext|>word, <|endoftext",
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(None if i == 3 else i // 2, t, "x", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, rank int").repartition(3)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library(plain, small_dir, spark):
    texts = [r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("text").collect()]
    model = Encoder(PATH, words=500)  # emptied often
    for some in (texts[:100], [t or "" for t in TEXTS], texts[100:]):
        assert [np.frombuffer(x, model.dtype).tolist() for x in model.encode(some)] == [plain(t) for t in some]


def test_pieces_cover_documents_and_sequences_have_no_gaps(docs, plain):
    rows = packing.pack(docs, PATH, end_id=0, capacity=64).collect()
    expected = sorted(crc(ids[a : a + n]) for t in TEXTS for ids in [plain(t) + [0]] for a, n in packing.cut(len(ids), 64))
    assert sorted(r.ids_crc32 for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in sequences.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 64


def test_lanes_do_not_change_the_packing(docs, monkeypatch):
    usual = packing.pack(docs, PATH, 0, 64)
    monkeypatch.setattr(packing, "LANE_ROWS", 2)
    lanes = packing.pack(docs, PATH, 0, 64)
    places = lambda df: sorted((r.length, r.sequence_id, r.offset) for r in df.collect())
    assert places(usual) == places(lanes)


def best_fit_by_hand(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else capacity) - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 41, 400).tolist() + [7] * 100
    histogram = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan(histogram, 40)
    places = [(s, o, r.length) for r in runs.itertuples() for s in range(r.sequence_id, r.sequence_id + r.n) for o in [r.offset]]
    assert sorted(p[2] for p in places) == sorted(lengths)
    assert len({p[0] for p in places}) == best_fit_by_hand(lengths, 40)
    for r in runs.groupby("length"):
        ranks = sorted(k for x in r[1].itertuples() for k in range(x.rank, x.rank + x.n))
        assert ranks == list(range(histogram[r[0]]))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert packing.pack(none, PATH).count() == 0
    folder = shared_folder(spark, "none")
    index = token_records.write(none, folder, PATH, 2)
    assert token_records.with_starts(token_records.read(index, folder), index).count() == 0


def test_records_round_trip(spark, docs, plain):
    folder = shared_folder(spark, "records")
    index = token_records.write(docs, folder, PATH, 2, file_bytes=200)  # files roll over
    found = token_records.with_starts(token_records.read(index, folder), index).collect()
    ids = [None if i == 3 else i // 2 for i in range(len(TEXTS))]
    at, expected = 0, []
    for i in sorted(range(len(TEXTS)), key=lambda i: (ids[i] is not None, ids[i] or 0, TEXTS[i] is not None, TEXTS[i] or "")):
        tokens = plain(TEXTS[i]) + [2]
        expected.append((ids[i], at, len(tokens), crc(tokens)))
        at += len(tokens)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    some = index.filter("doc_id in (1, 4)")  # any rows of the index
    assert sorted(r.ids_crc32 for r in token_records.read(some, folder).collect()) == sorted(
        e[3] for e in expected if e[0] in (1, 4)
    )


def test_damage_is_found():
    data = token_records.frame(token_records.encode_document(7, b"\1\0\2\0", 2))
    doc_id, ids = token_records.decode_document(token_records.unframe(data))
    assert (doc_id, ids.tolist()) == (7, [1, 2])
    for i in range(len(data)):
        with pytest.raises(token_records.BadRecord):
            token_records.unframe(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])


def test_large_ids_beside_null_ids(spark):
    ids = [None, 9007199254740993, -9007199254740995, (1 << 63) - 1]
    df = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string").coalesce(1)
    folder = shared_folder(spark, "large-ids")
    index = token_records.write(df, folder, PATH, end_id=0)
    for found in (index, token_records.read(index.coalesce(1), folder), packing.tokenise(df, PATH, 0, 64), packing.pack(df, PATH, 0, 64)):
        assert {r.doc_id for r in found.collect()} == set(ids) and found.schema["doc_id"].dataType.simpleString() == "bigint"


def test_equal_rows_spread_over_lanes_ranges_and_files(spark, monkeypatch, plain):
    """A third of the rows without id and of one text: no lane, range or file takes them all."""
    monkeypatch.setattr(packing, "LANE_ROWS", 100)
    rows = [(None, "the same text")] * 3000 + [(i, f"text {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    packed = packing.pack(df, PATH, end_id=0, capacity=64)
    used = packed.groupBy("sequence_id", "offset").count()
    assert packed.count() == 9000 and used.filter("count > 1").count() == 0
    folder = shared_folder(spark, "equal-rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be one partition
    try:
        index = token_records.write(df, folder, PATH, end_id=2).filter("doc_id is null")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}
    assert sum(parts.values()) == 3000 and max(parts.values()) <= 1500
    assert {r.ids_crc32 for r in token_records.read(index, folder).collect()} == {crc([*plain("the same text"), 2])}


def test_folders_of_object_stores():
    pytest.importorskip("pyarrow.fs")
    for scheme in ("s3", "s3a", "s3n"):
        store, path = token_records.file_system(f"{scheme}://bucket/some/folder")
        assert (store.type_name, path) == ("s3", "bucket/some/folder")
    assert token_records.file_system("/a/b")[1] == "/a/b" and token_records.file_system("file:///a/b")[1] == "/a/b"
