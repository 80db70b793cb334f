"""Fill-in-middle cuts against plain splitting, and the wavelet matrix against counting."""

import hashlib
import random
import re

import numpy as np
import pytest

from rowloom.llm import fill_middle

from helpers import AWKWARD, awkward  # noqa: I001

TEXTS = [*AWKWARD, (20, "one\ntwo\n\nthree"), (21, "\n"), (22, "a <S> b\nc"), (23, "é ü.\n　x! y?\n" * 40), (24, "no end. Two\tthree"), (25, "<\nP>\n<P\n>S>\n")]
UNITS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+$", "sentence": r"(?s:.)*?[.!?](?=[ \t-\r]|\Z)|(?s:.)+\Z"}


def by_hand(doc_id, text, unit="line", rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(UNITS[unit], text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", list(UNITS))
def test_cuts_by_hand(spark, unit):
    made = fill_middle.fill_in_middle(awkward(spark, TEXTS), unit=unit)
    got = made.withColumn("back", fill_middle.restored(made.output, made.form)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((by_hand(i, t, unit) for i, t in TEXTS), key=repr)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in TEXTS)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_rates_and_seed(spark):
    texts = [(i, "a\nb\nc\nd\ne") for i in range(60)]
    got = fill_middle.fill_in_middle(awkward(spark, texts), rate=40, spm_rate=0, seed=3).collect()
    assert sorted(tuple(r) for r in got) == sorted(by_hand(i, t, rate=40, spm=0, seed=3) for i, t in texts)
    assert {r.form for r in got} == {"plain", "psm"}


def test_empty_table_and_wrong_unit(spark):
    assert fill_middle.fill_in_middle(awkward(spark, [])).collect() == []
    with pytest.raises(ValueError, match="unit"):
        fill_middle.fill_in_middle(awkward(spark, []), unit="page")


def test_small_slices_cut_alike(monkeypatch):
    texts = [(t or "").encode() for _, t in TEXTS if len(t or "") < 1000]
    draws = np.array([[random.Random(i * 4 + k).getrandbits(32) for k in range(4)] for i in range(len(texts))])
    whole = list(fill_middle.transform(texts, draws))
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 5)
    assert list(fill_middle.transform(texts, draws)) == whole


def test_wavelet_matrix_counts():
    draw = np.random.default_rng(3)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = draw.integers(0, 7, size).astype(np.uint8)
        matrix = fill_middle.WaveletMatrix(symbols, 3)
        places = np.arange(size + 1)
        for symbol in range(8):
            assert matrix.rank(symbol, places).tolist() == [int((symbols[:p] == symbol).sum()) for p in places]
