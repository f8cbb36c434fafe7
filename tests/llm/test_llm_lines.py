from tidemark.llm.line_dedup import dedup_lines, line_key

LONG = "this line is long enough"


def result(frame):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect()}


def test_keys():
    assert line_key(b"  " + LONG.upper().encode() + b"\r", 20) == line_key(LONG.encode(), 20)
    assert line_key("É".encode() * 19, 20) is None and line_key("É".encode() * 20, 20) is not None
    assert line_key("É".encode() * 20, 20) != line_key("é".encode() * 20, 20)
    assert line_key(b"a" * 19, 20) is None and line_key(b"\x0b" * 30, 20) is None


def test_lines_stay_in_the_last_document(docs):
    rows = [
        (1, f"a\n{LONG}\nb\n{LONG}"),
        (2, f"\t{LONG.upper()} \nb"),
        (9, f"{LONG}\n\n{LONG}"),
        (4, "twice is not enough here\nshort"),
        (5, "twice is not enough here\nshort"),
        (6, "short"),
        (7, None),
        (8, ""),
    ]
    assert result(dedup_lines(docs(rows))) == {
        1: ("a\nb", 4, 2),
        2: ("b", 2, 1),
        9: (f"{LONG}\n\n{LONG}", 3, 0),
        4: ("twice is not enough here\nshort", 2, 0),
        5: ("twice is not enough here\nshort", 2, 0),
        6: ("short", 1, 0),
        7: ("", 1, 0),
        8: ("", 1, 0),
    }


def test_repeated_and_null_ids_and_carried_columns(docs):
    rows = [(1, LONG), (1, LONG), (2, LONG), (None, LONG), (None, LONG)]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in dedup_lines(docs(rows)).collect()) == [(0, LONG), (0, LONG), (1, LONG), (1, LONG), (2, LONG)]
    kept = dedup_lines(docs([*rows, (3, LONG)]), keep=["score", "component_id"])
    assert kept.columns == ["doc_id", "text", "score", "component_id", "n_lines", "n_dropped"]
    assert sorted((r["doc_id"] or 0, r["text"], r["score"]) for r in kept.collect())[2:] == [(1, "", 1.5), (1, "", 1.5), (2, "", 1.5), (3, LONG, 1.5)]
    assert dedup_lines(docs([])).collect() == []
