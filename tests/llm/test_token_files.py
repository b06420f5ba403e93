"""Token files against the plain library call, and the cache of units."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourglass.llm.spans import SpanCache, join_documents, runs
from hourglass.llm.support import shared_path
from hourglass.llm.token_files import END_ID, TextEncoder, cuttable, default_tokenizer, read_tokens, tokenise_documents, write_tokens

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def plain(library, docs):
    """(doc_id, start, n_tokens, ids_crc32) by the plain call on whole texts."""
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = plain(library, [tuple(r) for r in rows.collect()])
    assert sorted(tuple(r) for r in tokenise_documents(rows).collect()) == want


def test_cut_texts_give_the_ids_of_whole_texts(library):
    rng = random.Random(3)
    bits = [" ", "  ", "\t", "\n", "\r\n", " ", "　", " ", "\x85", "\x1c", "\x00", "a", "I'll", "'s", " 's", "don't", "12", " 3.5", "é", "中文", "🙂", "!?", "_", "~", "\x7f", "<|endoftext|>", " <|endoftext|> ", "<|end", "of|>", "word", " next", "​"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", " ", "x" * 5000, " y" * 3000]
    encoder = TextEncoder(default_tokenizer())
    assert encoder.cut
    ids, n = encoder.encode([t.encode() for t in texts])
    for text, own in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_are_not_cut():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert not cuttable(path)
    ids, n = TextEncoder(path).encode([b"Some Words  here", b""])
    assert ids.tolist() == Tokenizer.from_file(path).encode("Some Words  here", add_special_tokens=False).ids and n[1] == 0


def test_rolled_files_null_ids_and_clashing_columns(spark, library):
    texts = [None, "", "one two", "three  four\n", "é " * 400, "same", "same"]
    docs = [(i if i < 6 else 5, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None)]
    frame = spark.createDataFrame([(i, t, "a", 7) for i, t in docs], "doc_id long, text string, shard string, ids int").repartition(2)
    folder = shared_path(spark, "tokens")
    manifest = write_tokens(frame, folder, default_tokenizer(), file_ids=5)
    got = [tuple(r) for r in read_tokens(spark, folder, manifest).collect()]
    key = lambda r: r[1]
    want = plain(library, docs)
    assert [r[0] for r in sorted(got, key=key)] == [r[0] for r in want]
    # Rows of one id may follow each other in either order.
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    assert manifest.agg(F.max("part")).first()[0] >= 0 and manifest.agg(F.sum("documents")).first()[0] == len(docs)
    assert manifest.count() > 2


def test_cache_starts_anew_within_its_limit():
    cache, calls = SpanCache(limit=4000), []

    def compute(units):
        calls.append(len(units))
        return np.concatenate([np.frombuffer(u, np.uint8).astype(np.int32) for u in units]), np.array([len(u) for u in units])

    for k in range(20):
        words = [f"w{(k * 13 + i) % 97}".encode() for i in range(60)]
        buf, _ = join_documents([b" ".join(words)])
        starts, ends = runs((buf != 0x20) & (buf != 0x0A))
        values, lengths = cache.values(buf, starts, ends, compute)
        assert [bytes(v.astype(np.uint8)) for v in np.split(values, np.cumsum(lengths)[:-1])] == words
        assert cache.spans * cache.SPAN_BYTES + 4 * cache.used <= 4000 + 60 * 32
    assert len(calls) > 2
