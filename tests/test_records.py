import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.records import log_records, parse_records, split_dirty, to_text
from tidemark.operators.split import route_channels
from tidemark.plans.jobs import daily_unique_visitors, jump_outs, split_traffic

PAGE = (
    '{"common":{"mid":"m1","is_new":"1"},"page":{"page_id":"home"},"actions":[{"action_id":"cart_add"}],'
    '"displays":[{"item":"9"},{"item":4}],"ts":1704067200000,"extra":{"kept":[1,2.5]}}'
)
DETAIL = '{"common":{"mid":"m1","is_new":"1"},"page":{"page_id":"detail","last_page_id":"home"},"ts":1704067203000}'
START = '{"common":{"mid":"m2","is_new":"0"},"start":{"entry":"icon"},"ts":1704067204000}'
ERR = '{"common":{"mid":"m2","is_new":"0"},"err":{"code":1},"start":{"entry":"icon"},"ts":1704067205000}'
DIRTY = [
    "oops", "[1]", "null", "", None, "12", '"text"', "{}", '{"a":1} trailing', PAGE + PAGE, PAGE[:-1],
    '{"common":"m1","ts":1}',
    '{"common":{"is_new":"1"},"ts":1}',
    '{"common":{"mid":"m1"},"ts":1}',
    '{"common":{"mid":"m1","is_new":"1"}}',
    '{"common":{"mid":"m1","is_new":"1"},"ts":9223372036854775807}',
]


def raw(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "seq bigint, value string")


def routed(df):
    out = {}
    for r in df.orderBy("seq", "channel", "position").collect():
        out.setdefault(r.seq, []).append((r.channel, r.position, r.value))
    return out


def test_dirty_rows_keep_their_text(spark):
    clean, dirty = split_dirty(log_records(raw(spark, [PAGE] + DIRTY)))
    assert [r.seq for r in clean.collect()] == [0]
    assert sorted((r.seq, r.value) for r in dirty.collect()) == list(enumerate(DIRTY, 1))


def test_blanks_around_a_record_are_fine(spark):
    row = log_records(raw(spark, [f"  {DETAIL} "])).first()
    assert (row.mid, row.is_new, row.ts, row.is_dirty) == ("m1", "1", 1704067203000, False)


def test_numbers_in_place_of_text(spark):
    row = log_records(raw(spark, ['{"common":{"mid":7,"is_new":1},"ts":"17"}'])).first()
    assert (row.mid, row.is_new, row.ts) == ("7", "1", 17)


def test_text_round_trip(spark):
    parsed = parse_records(raw(spark, [PAGE])).select(to_text("record").alias("t")).first()
    assert json.loads(parsed.t) == json.loads(PAGE)


def test_route(spark):
    out = routed(route_channels(log_records(raw(spark, [PAGE, DETAIL, START, ERR, "oops"]))))
    page = json.loads(PAGE)
    common, where = page["common"], page["page"]
    assert [(c, p) for c, p, _ in out[0]] == [("action", 0), ("display", 0), ("display", 1), ("page", 0)]
    action, first, second, main = [json.loads(v) for _, _, v in out[0]]
    assert action == {"page": where, "common": common, "action": {"action_id": "cart_add"}, "ts": page["ts"]}
    assert first == {"page": where, "common": common, "display": {"item": "9"}, "ts": page["ts"]}
    assert second["display"] == {"item": 4}
    assert main == {k: v for k, v in page.items() if k not in ("actions", "displays")}
    assert [(c, json.loads(v)) for c, _, v in out[1]] == [("page", json.loads(DETAIL))]
    assert [(c, json.loads(v)) for c, _, v in out[2]] == [("start", {"entry": "icon"})]
    assert [(c, json.loads(v)) for c, _, v in out[3]] == [("err", json.loads(ERR))]
    assert out[4] == [("dirty", 0, "oops")]


def test_route_element_context(spark):
    line = (
        '{"common":{"mid":"m","is_new":"0"},"page":{"page_id":"home"},"ts":5,'
        '"actions":[{"action_id":"a","page":"p"}],"displays":[{"item":"9"}]}'
    )
    out = routed(route_channels(log_records(raw(spark, [line])), context="element"))[0]
    assert json.loads(out[0][2]) == {"page": "p", "action": {"action_id": "a", "page": "p"}}
    assert json.loads(out[1][2]) == {"display": {"item": "9"}, "ts": 5}


def test_route_options(spark):
    out = routed(route_channels(log_records(raw(spark, [START])), keep_start_context=True))[0]
    record = json.loads(START)
    assert json.loads(out[0][2]) == {k: record[k] for k in ("common", "start", "ts")}
    with pytest.raises(ValueError):
        route_channels(log_records(raw(spark, [START])), context="other")


@pytest.mark.parametrize("parts", ['"actions":[]', '"actions":null,"displays":[]', '"err":null,"start":null'])
def test_empty_parts_give_only_the_page(spark, parts):
    line = '{"common":{"mid":"m","is_new":"0"},"page":{"page_id":"home"},"ts":5,' + parts + "}"
    out = routed(route_channels(log_records(raw(spark, [line]))))[0]
    assert [c for c, _, _ in out] == ["page"]
    record = json.loads(out[0][2])
    assert "actions" not in record and "displays" not in record


def test_split_repairs_before_routing(spark):
    day = 86_400_000
    lines = [
        PAGE,
        DETAIL.replace("1704067203000", str(1704067203000 + day)),
        ERR.replace('"is_new":"0"', '"is_new":"1"'),
        ERR.replace('"is_new":"0"', '"is_new":"1"').replace("1704067205000", str(1704067205000 + day)),
        "oops",
        PAGE.replace("1704067200000", str(1704067200000 + 2 * day)),
        '{"common":{"mid":"m1","is_new":"1"},"ts":9223372036854775807}',
        START.replace('"0"', '"1"').replace("1704067204000", str(1704067204000 + day)),
    ]
    out = routed(split_traffic(raw(spark, lines), keep_start_context=True))
    flags = {
        seq: {json.loads(v)["common"]["is_new"] for c, _, v in items if c != "dirty"} for seq, items in out.items()
    }
    assert flags == {0: {"1"}, 1: {"0"}, 2: {"1"}, 3: {"0"}, 4: set(), 5: {"0"}, 6: set(), 7: {"0"}}
    fixed = json.loads(out[1][0][2])
    assert fixed == {**json.loads(lines[1]), "common": {"mid": "m1", "is_new": "0"}}
    assert json.loads([v for c, _, v in out[5] if c == "page"][0])["extra"] == {"kept": [1, 2.5]}


def test_page_jobs(spark):
    entry = DETAIL.replace(',"last_page_id":"home"', "")
    blank = DETAIL.replace('"home"', '""')
    pages = raw(spark, [entry, DETAIL, blank, entry.replace("7203000", "7209000"), "oops"])
    uv = daily_unique_visitors(pages).collect()
    assert [(r.seq, r.value) for r in uv] == [(0, entry)]
    pairs = jump_outs(pages.where(F.col("seq").isin(2, 3))).collect()
    assert [(r.mid, r["first"].value, r["second"].seq) for r in pairs] == [("m1", blank, 3)]


def test_white_space_around_records_and_repeated_keys(spark):
    lines = [" \t\r\n" + PAGE + "\n", "\u00a0" + PAGE, PAGE.replace('"is_new":"1"', '"is_new":"0","is_new":"1"')]
    assert [(r.mid, r.is_new, r.is_dirty) for r in log_records(raw(spark, lines)).orderBy("seq").collect()] == [
        ("m1", "1", False),
        (None, None, True),
        ("m1", "1", False),
    ]
