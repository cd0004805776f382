"""Fill-in-middle against a plain version, and round trips."""

import hashlib
import re

import pytest

pytest.importorskip("tessella.llm")

from hypothesis import given, settings, strategies as st  # noqa: E402

from tessella.llm.infill import PLAIN, digest, draws, fill_in_middle, restore_texts, restored, streamed, transformed  # noqa: E402


def plainly(doc_id, text):
    """Form, tokens, characters of prefix and middle, and output, by lists of tokens."""
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[i : i + 8], 16) for i in range(0, 32, 8)]
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    lo, hi = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    pre, mid, suf = ("".join(x) for x in (tokens[:lo], tokens[lo:hi], tokens[hi:]))
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(tokens), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(deadline=None, max_examples=300)
@given(st.integers(), st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("<>PSMab \n"))))
def test_as_plain_and_back(doc_id, text):
    n, form, prefix, middle, pieces = transformed(text.encode(), draws(doc_id))
    output = b"".join(streamed(pieces))
    assert (n, form, prefix, middle, output.decode()) == plainly(doc_id, text)
    assert b"".join(streamed(restored(output, form))) == text.encode()
    assert digest(pieces) == hashlib.sha256(output).hexdigest()


def test_table_of_odd_rows(spark, documents, long_text):
    texts = [None, "", "<P>", "a <S> b", "<", "same text", "same text", "zoë 漢字\x00\r\n", long_text, *[f"word{i} <" * i for i in range(60)]]
    ids = [None, 1, 2, 3, 4, 5, 5, 7, 8, *range(9, 69)]
    docs = documents(texts, ids=ids)
    got = fill_in_middle(docs)
    back = restore_texts(got).collect()
    assert len(back) == len(texts)
    want = sorted((i, *plainly(i, t or ""), t or "") for i, t in zip(ids, texts, strict=True) if i is not None)
    rows = sorted((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in back if r.doc_id is not None)
    assert sorted(rows, key=str) == sorted(want, key=str)
    for r in back:
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    (null,) = [r for r in back if r.doc_id is None]
    assert (null.form, null.output, null.text) == (PLAIN, "", "")
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    assert fill_in_middle(documents([])).count() == 0


def test_nothing_and_everything_is_cut(spark, documents):
    docs = documents(["some text here"] * 20)
    assert {r.form for r in fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle(docs, rate=100, suffix_first=100).collect()} == {"spm"}
