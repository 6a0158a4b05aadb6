"""Lines whose fields are closed are not looked through one by one, and the states of all lines stay the same."""

import random

import numpy as np
import pyarrow as pa

from ledgerline.sources import records
from ledgerline.sources.records import ends_inside, states


def _one_by_one(lines, inside):
    out = []
    for line in lines:
        out.append(inside)
        inside = ends_inside(line, inside)
    return out, inside


def test_states_are_those_of_every_line_read():
    rng = random.Random(7)
    parts = [b'"', b'""', b",", b"a", b"\\", b"\r", "۱".encode(), b'"a,b"', b',"x"', b"\xff"]
    for n in range(3000):
        lines = [b"".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(rng.randrange(12))]
        for inside in (False, True):
            got, last = states(pa.array(lines, pa.binary()), inside)
            want, want_last = _one_by_one(lines, inside)
            assert (got.tolist(), last) == (want, want_last), lines


def test_closed_lines_are_not_looked_through(monkeypatch):
    looked = []
    monkeypatch.setattr(records, "ends_inside", lambda line, inside: looked.append(line) or ends_inside(line, inside))
    lines = [b'1,"a, ""b""",2'] * 1000 + [b'2,"open', b'still", 3'] + [b'3,"c,d"'] * 1000
    got, last = states(pa.array(lines, pa.binary()), False)
    assert looked == [b'2,"open', b'still", 3'] and not last and np.flatnonzero(got).tolist() == [1001]


def test_both_assumptions_are_followed_until_they_meet(monkeypatch):
    calls = []
    real = states
    monkeypatch.setattr(records, "states", lambda lines, inside: calls.append(inside) or real(lines, inside))

    def batch(lines):
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array([5] * n, pa.int64()),
                                           pa.array([9] * n, pa.int64())], ["value", "file", "block"])
    out = list(records._surveyed([batch([b"a,b", b'1,"x"', b"2,y"]), batch([b"3,z", b'4,"w"']), batch([b'5,"open'])]))
    row = out[0].to_pylist()[0]
    assert calls == [False, True, False, False]
    assert (row["ends_out"], row["ends_in"], row["n_out"], row["n_in"]) == (True, True, 6, 4)
