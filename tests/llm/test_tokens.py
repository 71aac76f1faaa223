import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import registry, tokens
from ledgerlens.llm.common import mapped


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip_and_random_access(values):
    codes = tokens.Codes.from_buffer(tokens.Codes.encode(np.array(values, dtype=np.uint32)).to_bytes())
    assert codes.all().tolist() == values
    if values:
        at = np.random.default_rng(0).integers(0, len(values), 50)
        assert codes.at(at).tolist() == [values[i] for i in at]


def _brute(rows):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(registry.tokenizer_path()), 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("cache", [600_000, 50])
def test_word_memory_never_changes_ids(spark, sf_dir, cache, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", cache)
    encode = tokens.WordEncoder(registry.tokenizer_path())
    odd = ["it's DON'T we'LL x'sy <|endoftext|>a <|startoftext|>", "ﬁ é İI ǅ  a b\x1cc\u0085d", "áb 東京123 ​🙂🙂", "ΑΣ ΣΑΣ.", ""]
    texts = odd + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(40).collect()]
    together = encode([t.encode() for t in texts])
    for t, also in zip(texts, together):
        want = _brute([(0, t)])[0]
        got = encode([t.encode()])[0]
        assert got.tolist() == also.tolist()
        assert (len(got), zlib.crc32(got.astype("<u4").tobytes())) == want[2:], t[:80]


def test_query_equals_whole_text_encoding(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = [tuple(r) for r in registry.op2_token_files(spark, sf_dir).orderBy("doc_id").collect()]
    assert got == _brute(rows)


def test_odd_documents_and_direct_reading(spark, odd_docs, no_docs, tmp_path):
    manifest = tokens.write_tokens(odd_docs, str(tmp_path), registry.tokenizer_path(), roll_tokens=5)
    got = [tuple(r[1:]) for r in tokens.read_documents(manifest, str(tmp_path)).orderBy("start").collect()]
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == _brute(rows)
    for name in os.listdir(tmp_path):
        if name.endswith(".dac"):
            file = tokens.TokenFile(mapped(str(tmp_path / name)))
            assert np.concatenate([file.doc(i) for i in range(len(file.doc_ids))]).tolist() == file.codes.all().tolist()
    assert tokens.round_trip(no_docs, registry.tokenizer_path()).count() == 0
