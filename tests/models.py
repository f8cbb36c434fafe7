"""Row-by-row models of the keyed operators, written from their stated rules."""

from datetime import datetime, timedelta, timezone

ZONE = timezone(timedelta(hours=8))
DAY_MS = 86_400_000


def day_of(ms):
    return datetime.fromtimestamp(ms / 1000, ZONE).strftime("%Y-%m-%d")


def repair(rows):
    """rows: (seq, mid, ts, is_new) -> {seq: is_new}."""
    first, out = {}, {}
    for seq, mid, ts, is_new in sorted(rows):
        if mid not in first:
            first[mid] = day_of(ts) if is_new == "1" else day_of(ts - DAY_MS)
        out[seq] = "0" if is_new == "1" and day_of(ts) != first[mid] else is_new
    return out


def daily_uv(rows):
    """rows: (seq, mid, ts, last_page) -> set of seq."""
    last, out = {}, set()
    for seq, mid, ts, last_page in sorted(rows, key=lambda r: r[0]):
        if last_page is not None:
            continue
        if last.get(mid) != day_of(ts):
            out.add(seq)
        last[mid] = day_of(ts)
    return out


def jump_outs(rows, within_ms):
    """rows: (seq, mid, ts, last_page) -> set of (seq, seq)."""
    before, out = {}, set()
    for seq, mid, ts, last_page in sorted(rows, key=lambda r: (r[2], r[0])):
        entry = not last_page
        if mid in before:
            seq1, ts1, entry1 = before[mid]
            if entry1 and entry and ts - ts1 < within_ms:
                out.add((seq1, seq))
        before[mid] = (seq, ts, entry)
    return out


def timeouts(rows, within_ms):
    """rows: (seq, mid, ts, last_page) -> seq of entry pages that nothing follows in time."""
    ahead, out = {}, []
    for seq, mid, ts, last_page in sorted(rows, key=lambda r: (r[2], r[0]), reverse=True):
        if not last_page and (mid not in ahead or ahead[mid] - ts >= within_ms):
            out.append(seq)
        ahead[mid] = ts
    return out


def as_of(records, changes):
    """records: (seq, table); changes: (seq, table, deleted, sink) -> {seq: sink}."""
    out = {}
    for seq, table in records:
        known = [c for c in changes if c[1] == table and c[0] <= seq]
        if known:
            _, _, deleted, sink = max(known)
            if not deleted:
                out[seq] = sink
    return out
