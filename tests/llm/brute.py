"""Plain versions of the repeat removers."""

import hashlib

import numpy as np


def covered(seqs, length):
    """seqs: {doc_id: list or bytes}; {doc_id: mask of elements in a window that starts earlier}."""
    seen, out = set(), {}
    for d in sorted(seqs):
        s = seqs[d]
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - length + 1):
            w = s[i:i + length] if isinstance(s, bytes) else tuple(s[i:i + length])
            if w in seen:
                gone[i:i + length] = True
            else:
                seen.add(w)
        out[d] = gone
    return out


def words_result(docs, length=20):
    seqs = {d: (t or "").encode().split() for d, t in docs.items()}
    out = {}
    for d, gone in covered(seqs, length).items():
        kept = b" ".join(w for w, g in zip(seqs[d], gone) if not g)
        out[d] = (len(seqs[d]), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    return out


def bytes_result(docs, length=100):
    seqs = {d: (t or "").encode() for d, t in docs.items()}
    out = {}
    for d, gone in covered(seqs, length).items():
        a = np.frombuffer(seqs[d], np.uint8)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[d] = (len(a), int(gone.sum()), spans, hashlib.sha256(a[~gone].tobytes()).hexdigest())
    return out
