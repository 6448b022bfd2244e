"""Token files: exact round trip, access to single documents, checksums."""

import io

import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from tokenizers import Tokenizer

from logharrow.llm import token_files as T

PATH = P.path("byte_bpe_50k.json")


def test_round_trip(spark, docs, awkward):
    manifest = T.write_token_files(docs(awkward), PATH, T.token_files_path(spark), partitions=3)
    got = T.read_token_files(manifest).orderBy("start").collect()
    order = sorted(awkward, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    whole, start = Tokenizer.from_file(PATH), 0
    for r, (i, t) in zip(got, order, strict=True):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids)) and np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    assert T.read_token_files(T.write_token_files(docs([]), PATH, T.token_files_path(spark))).count() == 0


def sample():
    out = io.BytesIO()
    writer = T.TokenFileWriter(out, 2)
    texts = [np.arange(100), np.zeros(0, int), np.arange(T.FRAME_IDS + 5) % 50_000]
    for i, ids in enumerate(texts):
        writer.add(i, ids)
    writer.close()
    return out, texts


def test_single_documents_and_frames():
    out, texts = sample()
    reader = T.TokenFileReader(out)
    assert all((reader.read(k) == texts[k]).all() for k in (2, 0, 1)) and list(reader.n_frames) == [1, 0, 2]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()  # any zstd reader skips the tables
    assert plain == b"".join(t.astype("<u2").tobytes() for t in texts)


def test_damage_is_found():
    out, _ = sample()
    raw = bytearray(out.getvalue())
    raw[30] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        T.TokenFileReader(io.BytesIO(bytes(raw))).read(0)
    with pytest.raises(ValueError):
        T.TokenFileReader(io.BytesIO(bytes(raw[:-1])))


def test_read_documents(spark, docs, prose):
    """Only the wanted documents, each as often as it occurs."""
    rows = [(i // 2 * 3, prose(20, i)) for i in range(200)] + [(None, "x")]
    manifest = T.write_token_files(docs(rows), PATH, T.token_files_path(spark), partitions=5)
    wanted = spark.createDataFrame([(0,), (0,), (1,), (297,), (150,), (None,), (-5,), (9999,)], "doc_id long")
    got = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in T.read_documents(manifest, wanted).collect())
    whole = Tokenizer.from_file(PATH)
    assert got == sorted((i, [*whole.encode(t, add_special_tokens=False).ids, 0]) for i, t in rows if i in (0, 150, 297))
    assert sum(r.n_docs for r in manifest.collect()) == 201 and T.read_documents(manifest, wanted.limit(0)).count() == 0


def test_wide_ids():
    out = io.BytesIO()
    with pytest.raises(ValueError):
        T.TokenFileWriter(out, 2).add(1, np.array([70_000]))
    writer = T.TokenFileWriter(out, 4)
    writer.add(1, np.array([70_000, 5]))
    writer.close()
    assert T.TokenFileReader(out).read(0).tolist() == [70_000, 5]


def test_files_roll_over(spark, docs, prose, awkward):
    """Small limits make many files; all is read back in order, and single documents are found in theirs."""
    rows = [(i // 2 * 3, prose(20, i)) for i in range(120)] + awkward
    one = T.write_token_files(docs(rows), PATH, T.token_files_path(spark), partitions=2)
    many = T.write_token_files(docs(rows), PATH, T.token_files_path(spark), partitions=2, file_ids=400, file_docs=7)
    files = many.orderBy("part", "number").collect()
    assert len(files) > 20 and all(f.n_docs <= 7 for f in files) and sum(f.n_docs for f in files) == len(rows) and {f.number for f in files if f.part == 0} == set(range(sum(f.part == 0 for f in files)))
    last = {f.part: f.number for f in files}
    assert all(f.n_docs == 7 or f.n_tokens >= 400 or f.number == last[f.part] for f in files)
    read = lambda m: [(r.doc_id, r.start, bytes(r.ids)) for r in T.read_token_files(m).orderBy("start").collect()]
    assert read(one) == read(many)
    wanted = spark.createDataFrame([(0,), (6,), (177,)], "doc_id long")
    found = lambda m: sorted((r.doc_id, bytes(r.ids)) for r in T.read_documents(m, wanted).collect())
    assert found(one) == found(many) and len(found(many)) >= 6
