from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caselake.llm import rangecoder
from caselake.llm.rangecoder import BLOCK_IDS, decode_each, decode_ids, encode_each, encode_ids, read_ids, write_ids
from caselake.session import fresh_path, settings

PATH = public_tokenizers.path("byte_bpe_50k.json")
RNG = np.random.default_rng(0)


@pytest.mark.parametrize(
    "ids",
    [
        [],
        [0],
        [2**32 - 1, 0, 65535, 65536],
        RNG.integers(0, 2**32, 9000),
        np.zeros(3 * BLOCK_IDS),
        RNG.integers(0, 3, BLOCK_IDS + 1),
        np.minimum(RNG.zipf(1.3, 20_000), 50_000),
        np.tile(np.arange(500), 30),
    ],
    ids=["none", "one", "wide", "random", "zeros", "few", "skewed", "cycle"],
)
def test_round_trips(ids):
    ids = np.asarray(ids, np.uint32)
    assert np.array_equal(decode_ids(encode_ids(ids)), ids)


def test_predictable_ids_are_small():
    assert len(encode_ids(np.tile(np.arange(200, dtype=np.uint32), 400))) < 0.6 * 2 * 80_000


def order_0_bits(ids: np.ndarray) -> float:
    """What adaptive counts with an escape for new ids (16 bits each) would need for one block."""
    counts, bits = {}, 0.0
    for seen, value in enumerate(ids.tolist()):
        new = len(counts) + 1
        held = counts.get(value, 0)
        bits -= np.log2((held or new) / (seen + new)) - (0 if held else 16)
        counts[value] = held + 1
    return bits


def test_text_takes_fewer_bits_than_zlib_and_order_0(sf_dir):
    texts = [t or "" for t in pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()]
    found = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    ids = np.array([i for e in found for i in (*e.ids, 0)], np.uint32)
    blocks = [ids[i : i + BLOCK_IDS] for i in range(0, len(ids), BLOCK_IDS)]
    coded = 8 * len(encode_ids(ids)) / len(ids)
    plain = 8 * sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks) / len(ids)
    assert coded < 8.6 < plain and coded < 0.95 * sum(map(order_0_bits, blocks)) / len(ids)


def test_more_blocks_than_lanes(monkeypatch):
    monkeypatch.setattr(rangecoder, "LANES", 2)
    ids = RNG.integers(0, 900, 5 * BLOCK_IDS + 17).astype(np.uint32)
    assert np.array_equal(decode_ids(encode_ids(ids)), ids)


def test_the_coded_bytes_stay_those_of_earlier_files():
    i = np.arange(40_000, dtype=np.uint64)
    mixed = (i * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    ids = np.where(mixed % np.uint64(3) == 0, mixed % np.uint64(50_000), (i * i) % np.uint64(700)).astype(np.uint32)
    ids[::977] = (mixed[::977] << np.uint64(8)).astype(np.uint32)
    coded = encode_ids(ids)
    assert (len(coded), zlib.crc32(coded)) == (53_860, 1_117_466_144)
    assert np.array_equal(decode_ids(coded), ids)


def test_blocks_of_many_chunks_go_side_by_side(monkeypatch):
    runs, run = [], rangecoder._run
    monkeypatch.setattr(rangecoder, "_run", lambda *args: runs.append(len(args[1])) or run(*args))
    chunks = [np.minimum(RNG.zipf(1.3, n), 50_000).astype(np.uint32) for n in (3, 0, BLOCK_IDS, 700, 2 * BLOCK_IDS + 1)]
    coded = encode_each(chunks)
    assert all(np.array_equal(a, b) for a, b in zip(decode_each(coded), chunks, strict=True))
    assert runs == [6, 6]
    assert coded == [encode_ids(ids) for ids in chunks]
    assert decode_each([]) == [] == encode_each([])


def test_damage_is_found_and_blocks_are_independent():
    ids = RNG.integers(0, 300, 3 * BLOCK_IDS).astype(np.uint32)
    coded = bytearray(encode_ids(ids))
    coded[len(coded) // 2] ^= 255
    with pytest.raises(ValueError, match="block 1"):
        decode_ids(bytes(coded))
    with pytest.raises(ValueError, match="not a chunk"):
        decode_ids(b"nothing at all")


def test_files_give_back_every_document(spark, docs, clashing, monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for df in (docs, clashing):
        path = fresh_path(spark, "ids")
        write_ids(df, path, PATH, 0)
        found = sorted(read_ids(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in found] == [r.doc_id for r in rows]
        at = 0
        expected = {}
        for r in rows:
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
            expected.setdefault(r.doc_id, []).append(np.array(ids, "<u4").tobytes())
        for r in found:
            assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
            at += r.n_tokens
            expected[r.doc_id].remove(bytes(r.ids))


def test_small_ranges_share_a_task(spark):
    """One step of the coder takes as long for one block as for many; 60 tasks of one block each were 60 runs."""
    n, ranges, cores = 3000, 60, spark.sparkContext.defaultParallelism
    df = spark.range(n).selectExpr("id * 7 % 3000 AS doc_id", "concat('a text of ', id) AS text")
    path = fresh_path(spark, "ids")
    with settings(spark, {"spark.sql.shuffle.partitions": str(ranges)}):
        write_ids(df, path, PATH, 0)
        found = sorted(read_ids(spark, path).collect(), key=lambda r: r.start)
    files = spark.read.parquet(path)
    assert files.select("part").distinct().count() == files.count() > cores
    assert files.select(F.input_file_name()).distinct().count() <= cores
    assert [r.doc_id for r in found] == list(range(n))
    assert [r.start for r in found[1:]] == list(np.cumsum([r.n_tokens for r in found])[:-1])


def test_no_documents(spark, no_docs):
    path = fresh_path(spark, "ids")
    write_ids(no_docs, path, PATH, 0)
    assert read_ids(spark, path).count() == 0
