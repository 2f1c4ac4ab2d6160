"""Packed hash exchange between document batches and hash buckets.

Corpus-wide questions about hundreds of hashes a document ("does this gram
occur elsewhere?", "how often?") would need a Spark row per hash. Here a batch
of documents sends one binary row per bucket with its distinct hashes, the
bucket answers with one byte or count per hash in the same order, and the
answers come back to the batch. Hot hashes cost a bucket one entry a batch,
however many documents hold them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ASK = "bucket int, batch long, keys binary, marks binary"
ANSWER = "batch long, bucket int, answer binary"
_ASK = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("marks", pa.binary())])
_ANSWER = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())])


def _order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    home = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    used, first = np.unique(home[order], return_index=True)
    return order, used, np.append(first, len(keys))


def ask(batch: int, keys: np.ndarray, marks: np.ndarray, buckets: int, width: int = 8) -> pa.Table:
    """One row per bucket that any key goes to; of a key its `width` high bytes
    are sent (the bucket adds the low bits' remainder)."""
    order, used, first = _order(keys, buckets)
    k, m = np.ascontiguousarray(keys[order].view(np.uint8).reshape(-1, 8)[:, 8 - width :]), marks[order]
    cut = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
    return pa.table([pa.array(used, pa.int32()), pa.array([batch] * len(used), pa.int64()), pa.array([k[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([m[a:b].tobytes() for a, b in cut], pa.binary())], schema=_ASK)


def gather(t: pa.Table, width: int = 8, mark_type=np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, marks, row of each key) of all rows that met in a bucket."""
    ks, ms = t["keys"].to_pylist(), t["marks"].to_pylist()
    sizes = [len(k) // width for k in ks]
    sent = np.frombuffer(b"".join(ks), np.uint8).reshape(-1, width)
    keys = np.zeros((len(sent), 8), np.uint8)
    keys[:, 8 - width :] = sent
    return keys.view(np.uint64).ravel(), np.frombuffer(b"".join(ms), mark_type), np.repeat(np.arange(len(ks)), sizes)


def reply(t: pa.Table, row: np.ndarray, answers: np.ndarray) -> pa.Table:
    """Answers (in the order of gather) as one row per asking batch."""
    first = np.searchsorted(row, np.arange(t.num_rows + 1))
    return pa.table([t["batch"].combine_chunks(), t["bucket"].combine_chunks(), pa.array([answers[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())], schema=_ANSWER)


def answers(t: pa.Table, keys: np.ndarray, buckets: int, kind=np.uint8) -> np.ndarray:
    """A batch's answers in the order of its keys."""
    order, used, first = _order(keys, buckets)
    out = np.zeros(len(keys), kind)
    if t.num_rows:
        got = dict(zip(t["bucket"].to_pylist(), t["answer"].to_pylist(), strict=True))
        for u, a, b in zip(used.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
            out[order[a:b]] = np.frombuffer(got[u], kind)
    return out


def sorted_rows(t: pa.Table) -> pa.Table:
    """A batch's rows by id, equal ids by text, null ids last."""
    return t.take(pa.compute.sort_indices(t, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_end")).combine_chunks()


import pyarrow.compute  # noqa: E402,F401  sort_indices above
