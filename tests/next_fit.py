"""Brute-force check of the batcher."""

from __future__ import annotations


def next_fit_reference(tokens: list[int], cap: int) -> list[int | None]:
    """Plain sequential fold (one run): batch number per row, None if oversized."""
    out: list[int | None] = []
    batch = 0
    fill = 0
    open_rows = 0
    for t in tokens:
        if t > cap:
            out.append(None)
            continue
        if open_rows and fill + t > cap:
            batch += 1
            fill = t
            open_rows = 1
        else:
            if not open_rows:
                batch += 1
            fill += t
            open_rows += 1
        out.append(batch)
    return out
