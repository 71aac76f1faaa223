import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import langid, registry


def brute_bits(texts, text, order):
    """Code length by the definition, context by context and byte by byte."""
    tables = [{} for _ in range(order + 1)]
    for t in texts:
        t = b"\n" * order + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                context = tables[k].setdefault(t[i - k:i], {})
                context[t[i]] = context.get(t[i], 0) + 1
    total, text = 0.0, b"\n" * order + text
    for i in range(order, len(text)):
        gone: set = set()
        for k in range(order, -1, -1):
            context = {b: n for b, n in tables[k].get(text[i - k:i], {}).items() if b not in gone}
            if not context:
                continue
            whole = sum(context.values()) + len(context)
            if text[i] in context:
                total -= np.log2(context[text[i]] / whole)
                break
            total -= np.log2(len(context) / whole)
            gone |= set(context)
        else:
            total += np.log2(256 - len(gone))
    return total


SMALL = st.binary(max_size=30).map(lambda b: bytes(x & 3 for x in b))


@settings(deadline=None, max_examples=80)
@given(st.lists(SMALL, max_size=5), SMALL)
def test_code_lengths_equal_the_definition(texts, text):
    got = langid.code_lengths([langid.Model(texts)], [text, b"", text])[:, 0]
    assert got == pytest.approx([brute_bits(texts, text, langid.ORDER), 0, brute_bits(texts, text, langid.ORDER)])


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = registry.op10_language_id(spark, sf_dir).collect()
    out = [r for r in rows if r.held_out and lang[r.doc_id] is not None]
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.95


def test_odd_documents(odd_docs, no_docs):
    models = langid.fit(odd_docs, langid.held_out_column())
    got = {r.doc_id: r.predicted for r in langid.identify(odd_docs, models).collect()}
    assert all(got[i].lang == "und" and got[i].score == 0 for i in (2, 3, 5, 8))
    assert got[4].lang in models and set(models) <= {"en", "de", "fr"}
    assert langid.identify(no_docs, langid.fit(no_docs, langid.held_out_column())).count() == 0
    nothing = langid.identify(odd_docs, {}).collect()
    assert {r.predicted.lang for r in nothing} == {"und"}


def test_models_learn_from_all_over_a_long_text(spark):
    """A long text in one language under a heading in another: the heading is a small share of the sample."""
    body, head = "zwei drei vier " * 4000, "one two three " * 300
    rows = [(i, head + body if i % 2 else "short text here", "de" if i % 2 else "en") for i in range(40)]
    rows += [rows[1]] * 5
    models = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.F.lit(False))
    bits = {n: m.bits(langid.gram_codes(b"zwei drei vier " * 20)[0]).sum() for n, m in models.items()}
    assert set(models) == {"de", "en"} and bits["de"] * 5 < bits["en"]
    # 20 different texts of 4,000 bytes, each counted once.
    assert int(models["de"].levels[0].total.sum()) == 20 * langid.SAMPLE_BYTES
