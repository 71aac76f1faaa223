import hashlib
import random
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import alignment, registry

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = alignment._byte_letters()
ODD = [
    "  two  blanks ", " lead", "trail ", "\ttab\nline\r\n x", "a b  c", "ﬁ １２ ½ ² Ⅷ", "under▁score ▁ x", "<0x41> <s> </s> <unk> <|endoftext|>",
    "é ́x", "日本語 テスト 中文。", "\U0001f600 \U0001f468‍\U0001f469", "don't we'll 'tis '' I'm", "\x00 \x01\x1c \x1fa \x85 b", "a" * 300, "x​ ​y", "­soft ­", "…… — –", "1 2 3 4,5.6",
]


def groups_of(text):
    """Groups of both sides' ids by the definition, or none."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(B.id_to_piece(i)[3:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()
               for i in b]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return []
    out, i, j, x, y = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a) and (x < y or not out[-1][0]):
            x += len(a_bytes[i])
            out[-1][0].append(a[i])
            i += 1
        else:
            y += len(b_bytes[j])
            out[-1][1].append(b[j])
            j += 1
        if x == y and out[-1][0] and out[-1][1]:
            out.append(([], []))
    return out[:-1]


def brute(docs):
    """All columns of all ``(doc_id, text)``."""
    groups = [groups_of(t) for _, t in docs]
    links = [Counter(p for a, b in g for p in product(a, b)) for g in groups]
    n_docs = Counter(p for per_doc in links for p in per_doc)
    most = Counter()
    for (a, _), n in n_docs.items():
        most[a] = max(most[a], n)
    rows = []
    for (doc_id, _), g, per_doc in zip(docs, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((
            doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(per_doc.values()),
            sum(n for p, n in per_doc.items() if n_docs[p] == most[p[0]]),
            sum(n * n_docs[p] for p, n in per_doc.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows, {(a, b, n, n == most[a]) for (a, b), n in n_docs.items()}


def plain(rows):
    return sorted(map(tuple, rows), key=str)


def chunked(texts):
    shared = alignment.aligner(A_PATH, B_PATH)
    shared.known.clear()
    chunks, names, flat, sizes = shared([t.encode() for t in texts])
    stops = np.cumsum(sizes)
    return [";".join(names[c] for c in flat[e - n:e]) for e, n in zip(stops, sizes)]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(max_size=25) | st.sampled_from(ODD), max_size=5), st.randoms())
def test_chunks_give_the_groups_of_whole_texts(parts, rnd):
    text = " ".join(parts + rnd.sample(ODD, 3))
    expected = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups_of(text))
    assert chunked([text, "plain words", text]) == [expected, chunked(["plain words"])[0], expected]


def test_every_odd_text_beside_others():
    for text in ODD:
        expected = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups_of(text))
        assert chunked([text])[0] == expected, text
    assert any(not groups_of(t) for t in ODD) and sum(bool(groups_of(t)) for t in ODD) > 10


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 5), st.integers(1, 9)), max_size=30), min_size=1, max_size=9))
def test_heap_merge_adds_runs(runs):
    total = Counter()
    packed = []
    for run in runs:
        one = Counter()
        for a, b, n in run:
            one[a, b] += n
        total += one
        rows = sorted((a, b, n) for (a, b), n in one.items())
        if rows:
            packed.append(alignment.pack(*np.array(rows).T))
    if packed:
        a, b, n, best = alignment.unpack(alignment.merge_runs(packed))
        assert list(zip(a, b, n)) == sorted((x, y, m) for (x, y), m in total.items())
        most = {x: max(m for (z, _), m in total.items() if z == x) for x, _ in total}
        assert [bool(m) for m in best] == [n == most[x] for x, n in zip(a, n)]


@pytest.mark.parametrize("few", [False, True])
def test_query_equals_brute_force(spark, monkeypatch, few):
    if few:
        # Many small slices, several rounds of merges and many cells give the same.
        for name, value in {"FAN": 2, "CELL_BYTES": 200, "SLICE_BYTES": 500, "CACHE_CHUNKS": 20, "SEND_BYTES": 300}.items():
            monkeypatch.setattr(alignment, name, value)
    draw = random.Random(5)
    words = "the of and thing thinking Straße 1234 don't über naïve éclair x".split()
    docs = [(i, " ".join(draw.choices(words, k=draw.randrange(60)))) for i in range(60)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(7, docs[7][1]), (7, "other text"), (None, "the of"), (201, None), (202, "")]
    found = alignment.align(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), A_PATH, B_PATH)
    rows, pairs = brute(docs)
    assert {tuple(r) for r in found.pairs.collect()} == pairs
    sums = found.docs.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    assert plain(sums.collect()) == plain(r[:-1] for r in rows)
    if not few:
        assert plain(alignment.digest(spark.createDataFrame(docs, "doc_id long, text string"), A_PATH, B_PATH).collect()) == plain(rows)


def test_given_documents_equal_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = registry.queries()["op12_tokenizer_alignment"](spark, sf_dir).collect()
    assert plain(found) == plain(brute(docs)[0])


def test_odd_rows(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert plain(alignment.digest(odd_docs, A_PATH, B_PATH).collect()) == plain(brute(docs)[0])
    assert alignment.digest(no_docs, A_PATH, B_PATH).collect() == []
    assert alignment.align(no_docs, A_PATH, B_PATH).pairs.collect() == []
