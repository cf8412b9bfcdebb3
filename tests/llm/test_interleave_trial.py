"""A trial of the interleave merge of Burrows-Wheeler transforms, behind the README's figure.

Repeated-passage removal does not use it (see README): ``python tests/llm/test_interleave_trial.py``
prints its cost per byte and round on the texts of a documents table.
"""

import glob
import sys
import time

import numpy as np


def transform(texts):
    """The transform of a collection by plain sorting: one end symbol (0) per text, ends of
    earlier texts first."""
    rows = sorted((t[k:] + b"\x00", i, t[k - 1] if k else 0) for i, t in enumerate(texts) for k in range(len(t) + 1))
    return np.array([c for *_, c in rows], np.uint8)


def merge(first, second, rounds=None):
    """(merged transform, common prefix of each place with the one before, rounds). The
    interleave starts as first-then-second; round r sorts it by one more symbol."""
    which = np.concatenate([np.zeros(len(first), bool), np.ones(len(second), bool)])
    prefix = np.full(len(which), -1)
    block = np.zeros(len(which), np.int64)  # places that agree so far
    done = 0
    while rounds is None or done < rounds:
        symbol = np.empty(len(which), np.uint8)
        symbol[~which], symbol[which] = first, second
        order = np.argsort(symbol, kind="stable")
        # end symbols stand for different texts: their order is fixed, never refined
        pair = block[order] * 256 + symbol[order]
        edge = np.ones(len(pair), bool)
        edge[1:] = (pair[1:] != pair[:-1]) | (symbol[order][1:] == 0)
        fresh = np.cumsum(edge) - 1
        prefix[(prefix < 0) & edge] = done
        after = which[order]
        ends = int((symbol == 0).sum())
        after[:ends] = np.sort(after[:ends])  # of the first collection's texts, then the second's
        done += 1
        if (after == which).all() and (fresh == block).all():
            break
        which, block = after, fresh
    return symbol, prefix, done


def test_merge_equals_the_transform_of_the_union():
    a, b = [b"banana", b"bandana", b"an"], [b"ananas", b"cabana", b"banana"]
    got, prefix, rounds = merge(transform(a), transform(b))
    assert got.tolist() == transform(a + b).tolist()
    rows = sorted((t[k:] + b"\x00", i) for i, t in enumerate(a + b) for k in range(len(t) + 1))
    for (x, _), (y, _), p in zip(rows, rows[1:], prefix[1:]):
        same = next((k for k, (u, v) in enumerate(zip(x, y)) if u != v or u == 0), min(len(x), len(y)))
        assert p == same
    assert rounds > 6


if __name__ == "__main__":
    import pyarrow.parquet as pq

    path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/check_s/documents.parquet"
    files = sorted(glob.glob(f"{path}/*.parquet")) or [path]
    raw = "\n".join(x or "" for x in pq.read_table(files[0], columns=["text"])["text"].to_pylist()).encode()
    size = min(len(raw) // 2, 16 << 20)
    parts = [np.frombuffer(raw[k * size: (k + 1) * size], np.uint8) for k in range(2)]
    t = time.process_time()
    merge(*parts, rounds=10)  # the cost of a round does not depend on what the symbols say
    took = time.process_time() - t
    print(f"{2 * size} bytes, 10 rounds: {took / (2 * size * 10) * 1e9:.1f} ns a byte and round; "
          f"100 rounds: {took / (2 * size * 10) * 100 * 1e9:.0f} CPU seconds per GB of text")
