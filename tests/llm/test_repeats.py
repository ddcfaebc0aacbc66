"""Operators 2, 3 and 10 against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from by_hand import words_of

from quayside.llm import windows
from quayside.llm.line_dedup import dedup_lines
from quayside.llm.suffix_array import cut_repeated_strings, doubling
from quayside.llm.suffix_trees import cut_repeated_sequences
from quayside.llm.windows import Scheme


def removed(sequences: list, length: int) -> list[list[bool]]:
    """Which elements are covered by a window that starts twice or more."""
    counts = Counter(tuple(s[i : i + length]) for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        covered = [False] * len(s)
        for i in range(len(s) - length + 1):
            if counts[tuple(s[i : i + length])] > 1:
                covered[i : i + length] = [True] * length
        out.append(covered)
    return out


@pytest.mark.parametrize("threshold", [3, 25, 60])
def test_bytes_against_brute_force(frame, corpus, threshold):
    got = cut_repeated_strings(frame(corpus), threshold).collect()
    sequences = [(t or "").encode() for t in corpus]
    want = Counter()
    seen = set()
    for s, covered in zip(sequences, removed(sequences, threshold), strict=True):
        if any(covered):
            want[bytes(b for b, c in zip(s, covered, strict=True) if not c), sum(covered)] += 1
        seen.add(s)
    assert Counter((bytes(r["kept"]), r["n_removed"]) for r in got) == want
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


@pytest.mark.parametrize(("threshold", "group"), [(1, 10), (3, 10**5), (12, 2), (35, 10**5)])
def test_words_against_brute_force(frame, corpus, threshold, group):
    got = cut_repeated_sequences(frame(corpus), threshold, group).collect()
    sequences = [words_of(t) for t in corpus]
    want = Counter()
    for s, covered in zip(sequences, removed(sequences, threshold), strict=True):
        if any(covered):
            want[" ".join(w for w, c in zip(s, covered, strict=True) if not c), sum(covered)] += 1
    assert Counter((r["kept_text"], r["n_removed"]) for r in got) == want


def test_repeated_rows_repeat_each_other(frame):
    text = "one two three four five six"
    rows = [(7, text), (7, text), (None, text + " seven"), (8, "else")]
    got = {(r["_id"], r["n_removed"]) for r in cut_repeated_strings(frame(rows), 10).collect()}
    assert got == {(7, 27), (-(2**63), 27)}
    assert {r["kept_text"] for r in cut_repeated_sequences(frame(rows), 3).collect()} == {"", "seven"}


def test_empty_tables(frame, spark):
    none = frame(["x"]).limit(0)
    assert cut_repeated_strings(none).count() == 0
    assert cut_repeated_sequences(none).count() == 0
    assert dedup_lines(none).count() == 0


def test_long_documents_are_cut_with_an_overlap(monkeypatch):
    rng = np.random.default_rng(3)
    long = bytes(rng.integers(97, 123, 5000, dtype=np.uint8)).decode()
    monkeypatch.setattr(windows, "PART", 64)
    scheme = Scheme("byte", 30, 5, 4)
    values = windows.BYTE_VALUES[np.frombuffer(long.encode(), dtype=np.uint8)]
    begins = np.array([0, len(long)])
    starts = []
    for _, s, e in windows._parts(begins, scheme):
        which, anchor, first, last, _ = windows._anchors(scheme, values[s[0] : e[-1]], s - s[0], e - s[0])
        starts += [x + s[0] for a, b in zip(first, last, strict=True) for x in range(a, b + 1)]
        assert ((anchor >= first) & (anchor <= last + scheme.threshold)).all()
        assert len(which)
    assert starts == list(range(len(long) - 29))


def test_sliding_minimum():
    x = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 7, 200):
        want = [x[i : i + width].min() for i in range(len(x) - width + 1)]
        assert windows.sliding_minimum(x, width).tolist() == want


@pytest.mark.parametrize("threshold", [1, 2, 5, 64, 400, 1000])
def test_doubled_runs_cover_the_core(threshold):
    scheme = Scheme("byte", threshold, gram=max(1, threshold * 4 // 25), block=max(1, threshold * 2 // 25))
    covered = set()
    for offset, length in doubling(scheme):
        covered |= set(range(offset, offset + length))
    assert covered == set(range(scheme.core))


def lines_by_hand(rows, min_chars=10, least=2):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    last = 2**63 - 1
    holders: dict[str, set] = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, text in rows:
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            held = holders[key(line)]
            if len(key(line)) < min_chars or len(held) < least or min(held) == (last if i is None else i):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines_against_brute_force(frame):
    rows = [
        (3, "A shared line\nown line number one\nshort\nA shared line"),
        (1, "  a SHARED line \nshort\n\n"),
        (2, "x\r\na shared line\r\nnothing else in here"),
        (2, "x\r\na shared line\r\nnothing else in here"),
        (9, None),
        (8, ""),
        (7, "Ä shared line"),
        (6, "ä shared line"),
        (None, "a shared line\nof no document"),
        (None, "of no document"),
        (5, "a shared line"),
        (4, "\n".join(f"line of a long text {i % 700}" for i in range(3000))),
        (10, "\n".join(f"line of a long text {i}" for i in range(0, 900, 7))),
    ]
    got = [tuple(r) for r in dedup_lines(frame(rows)).collect()]
    assert sorted(got, key=repr) == sorted(lines_by_hand(rows), key=repr)
    got = [tuple(r) for r in dedup_lines(frame(rows), min_chars=3, min_documents=3).collect()]
    assert sorted(got, key=repr) == sorted(lines_by_hand(rows, 3, 3), key=repr)


def test_query_digests_are_those_of_the_texts(spark):
    from quayside.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sequences = [t.encode() for t in texts.values()]
    for name, length, join in (("op2_suffix_array", 400, b""), ("op3_suffix_trees", 35, b" ")):
        cells = sequences if not join else [s.split() for s in sequences]
        want = {}
        for i, s, covered in zip(texts, cells, removed(cells, length), strict=True):
            left = [x for x, c in zip(s, covered, strict=True) if not c]
            kept = bytes(left) if not join else b" ".join(left)
            want[i] = (len(s), sum(covered), hashlib.sha256(kept).hexdigest())
        rows = QUERIES[name](spark, sf_dir).collect()
        size = "n_words" if join else "n_bytes"
        assert {r["doc_id"]: (r[size], r["n_removed"], r["kept_sha256"]) for r in rows} == want


def thue_morse(letters: str, rounds: int) -> str:
    text = letters[0]
    for _ in range(rounds):
        text += text.translate(str.maketrans(letters, letters[::-1]))
    return text


def test_words_and_strings_made_to_a_pattern_are_told_apart(frame):
    """Polynomials modulo a power of two give each such word and its complement one hash."""
    one, other = thue_morse("ab", 11), thue_morse("ba", 11)
    shared = " ".join(f"w{i}" for i in range(34))
    assert cut_repeated_sequences(frame([f"{shared} {one}", f"{shared} {other}"])).count() == 0
    sequence = {w: " ".join(thue_morse(w, 11)) for w in ("ab", "ba")}
    rows = [sequence["ab"], sequence["ba"]]
    for got, units in (
        (cut_repeated_sequences(frame(rows), 1500), [words_of(t) for t in rows]),
        (cut_repeated_strings(frame([one, other]), 1500), [one.encode(), other.encode()]),
    ):
        want = Counter(sum(covered) for covered in removed(units, 1500) if any(covered))
        assert Counter(r["n_removed"] for r in got.collect()) == want


def test_byte_runs_are_polynomials_over_the_field():
    from quayside.llm.buffers import _FIELD_BASES, PRIME, ByteRuns, mixed

    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(0, 256, 40_000, dtype=np.uint8), np.full(1 << 20, 255, dtype=np.uint8)])
    start = np.array([0, 1, 16_383, 16_384, 39_900, 600_000, len(data) - 400])
    for base in (0, 1):
        runs = ByteRuns(data, base)
        want = [sum(int(x) * pow(_FIELD_BASES[base], i, PRIME) for i, x in enumerate(data[s : s + 400])) % PRIME for s in start]
        assert runs.at(start, 400).tolist() == mixed(np.array(want, dtype=np.uint64)).tolist()
        # sums of a whole part of the largest bytes do not overflow
        whole = runs.at(np.array([40_000]), 1 << 20)
        want = 255 * (pow(_FIELD_BASES[base], 1 << 20, PRIME) - 1) * pow(_FIELD_BASES[base] - 1, -1, PRIME) % PRIME
        assert whole.tolist() == mixed(np.array([want], dtype=np.uint64)).tolist()


def test_bytes_cost_no_product_over_the_field_each(monkeypatch):
    from quayside.llm import buffers

    text = pa.array(["".join(random.Random(6).choices("abc ", k=60_000))])
    start, times, multiplied = np.arange(0, 59_000, 1000), buffers.times, []

    def counting(a, b):
        multiplied.append(a.size)
        return times(a, b)

    scheme = Scheme("byte", 400, 64, 32)
    for base in (0, 1):  # the tables of powers are made once
        buffers.field_powers(base, 1 << 16)
    monkeypatch.setattr(buffers, "times", counting)
    for _, _, values in windows.sequences(scheme, text):
        windows.fingerprints(values, start, [(0, 400), (400, 400)])
    assert 0 < sum(multiplied) <= 2 * len(start)


def test_bytes_are_worked_on_in_parts_that_fit_the_cache(monkeypatch):
    """Any part size gives the same anchors, and parts of bytes hold a document of usual size."""
    scheme = Scheme("byte", 400, 64, 32)
    begins = np.arange(0, 4_000_001, 100_000)
    parts = [e[-1] - s[0] for _, s, e in windows._parts(begins, scheme)]
    assert sum(parts) == 4_000_000 and 200_000 <= min(parts) and max(parts) <= 1 << 18
    data = np.random.default_rng(8).integers(97, 100, 50_000, dtype=np.uint8)
    starts, found = np.arange(0, 49_000, 50), []
    for most in (1 << 18, 4096):
        monkeypatch.setattr(windows, "BYTE_PART", most)
        found.append(windows.fingerprints(lambda lo, hi: data[lo:hi], starts, [(0, 400), (-31, 431)]))
    assert (found[0][:, 1:] == found[1][:, 1:]).all() and len(set(found[0][0].tolist())) == len(starts)
