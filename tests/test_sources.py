import json
import random

import pytest

from beaconlake import schemas
from beaconlake.operators.quantiles import join_groups
from beaconlake.sources import alarms, catalog, graph, pages, results, table_functions
from beaconlake.streaming import tables

NOW = 1_706_659_200_000


# Pages


def _chain(spark, tokens):
    rows = [("r", i, "" if i == 0 else tokens[i - 1], t, str(i)) for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "request_id string, page_no long, token_in string, next_token string, body string")


@pytest.mark.parametrize(
    "mode, tokens, kept",
    [
        ("seen", ["A", "B", ""], 3),
        ("seen", ["A", "B", "A", "C"], 3),
        ("previous", ["A", "B", "A", "C"], 4),
        ("previous", ["A", "A", "B"], 2),
        ("previous", ["A", "", "B"], 2),
        ("seen", ["A", None, "B"], 2),
        ("previous", ["A", "B"], 2),
    ],
)
def test_accepted_pages(spark, mode, tokens, kept):
    found = pages.accept_pages(_chain(spark, tokens), mode).collect()
    assert sorted(r.page_no for r in found) == list(range(kept))


def test_groups_with_null_keys_join(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    groups = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert sorted(r.w for r in join_groups(rows, groups, ["k"]).collect()) == [10, 20]


# Alarms


def _member(**tags):
    return "<member>" + "".join(f"<{k}>{v}</{k}>" for k, v in tags.items()) + "</member>"


def _page(metric="", composite="", log="", token=""):
    return (
        '<DescribeAlarmsResponse xmlns="http://m/"><DescribeAlarmsResult>'
        f"<MetricAlarms>{metric}</MetricAlarms><CompositeAlarms>{composite}</CompositeAlarms><LogAlarms>{log}</LogAlarms>"
        f"<NextToken>{token}</NextToken></DescribeAlarmsResult></DescribeAlarmsResponse>"
    )


def _alarms(spark, *rows):
    return spark.createDataFrame(list(rows), "state string, page_no int, body string")


def test_open_alarms(spark):
    body = _page(
        metric=_member(
            AlarmArn="arn:1", AlarmName="a", StateValue="ALARM", StateReason=" Disk &lt; &#53; % &#xE9; ",
            Dimensions="", ActionsEnabled="TRUE", StateUpdatedTimestamp="2024-01-01T00:00:00.123Z",
            StateTransitionedTimestamp="soon",
        ) + _member(AlarmName="closed", StateValue="OK"),
        composite=_member(
            AlarmName="c", StateValue="ALARM", AlarmActions="<member>x</member><member></member><member>y</member>",
            Dimensions=_member(Name="z", Value='1"') + _member(Name="a", Value="&lt;") + _member(Name="", Value="q"),
        ),
        log=_member(AlarmName="007", StateValue="ALARM", Odd="<b>1</b><b>2</b><a>3</a>"),
        token="page2",
    )
    again = _page(metric=_member(AlarmArn="arn:1", AlarmName="later", StateValue="ALARM"))
    waiting = _page(metric=_member(AlarmName="w", StateValue="INSUFFICIENT_DATA") + _member(AlarmName="x", StateValue="ALARM"))
    given = _alarms(spark, ("ALARM", 1, body), ("ALARM", 2, again), ("INSUFFICIENT_DATA", 1, waiting))
    found = alarms.open_alarms(given)
    assert found.schema.simpleString() == schemas.OPEN_ALARMS.simpleString()
    rows = {r.alarm_name: r for r in found.collect()}
    assert set(rows) == {"a", "c", "007", "w"}
    assert [rows[n].alarm_type for n in ("a", "c", "007")] == ["MetricAlarm", "CompositeAlarm", "LogAlarm"]
    assert rows["a"].reason == "Disk < 5 % é" and rows["a"].actions_enabled is True
    assert str(rows["a"].state_updated_at) == "2024-01-01 00:00:00.123000" and rows["a"].state_transitioned_at is None
    assert rows["a"].dimensions == "{}" and rows["a"].alarm_actions == []
    assert rows["c"].alarm_actions == ["x", "y"] and rows["c"].dimensions == '{"z":"1\\"","a":"<"}'
    assert rows["c"].alarm_arn is None and rows["c"].actions_enabled is None
    assert rows["007"].dimensions is None and rows["w"].status == "INSUFFICIENT_DATA"
    assert rows["007"].configuration == (
        '{"AlarmName":"007","Odd":{"a":"3","b":["1","2"]},"StateValue":"ALARM"}'
    )
    read = alarms.read_alarm_pages(given)
    assert [r.next_token for r in read.orderBy("state", "page_no").collect()] == ["page2", "", ""]
    every = alarms.decode_alarm_pages(read, every=True).collect()
    assert len(every) == 7 and all(r.configuration for r in every)
    assert sorted(r.alarm.AlarmName for r in alarms.decode_alarm_pages(read).collect()) == ["007", "a", "c", "later", "w"]


@pytest.mark.parametrize("bad", ["<broken>", "", "<a></b>"])
def test_malformed_alarm_pages_raise(spark, bad):
    with pytest.raises(Exception):
        alarms.open_alarms(_alarms(spark, ("ALARM", 1, bad))).collect()


def test_pages_without_alarms(spark):
    assert alarms.open_alarms(_alarms(spark, ("ALARM", 1, _page()))).collect() == []


# Service graph


def _graph(spark, *bodies):
    rows = [("r", i, json.dumps(b) if isinstance(b, dict) else b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "request_id string, page_no int, body string")


def _stats(total, seconds=0.5, **parts):
    """Statistics of an edge; `errors`, `faults` and their throttled shares only where given."""
    found = {"TotalCount": total, "TotalResponseTime": seconds}
    for name, key in (("errors", "ErrorStatistics"), ("faults", "FaultStatistics")):
        if name in parts:
            found[key] = dict(zip(("TotalCount", "ThrottleCount"), parts[name]))
    return found


def test_a_graph_of_several_services_over_three_pages(spark):
    """Forward and backward edges, a service that is renamed on its last page, and one edge without statistics
    between two that have them."""
    front = {"ReferenceId": 40, "Name": "front", "Type": "web", "AccountId": "9", "Edges": [
        {"ReferenceId": 41, "SummaryStatistics": _stats(900, 45.0, errors=(8, 5))},
        {"ReferenceId": 42},
        {"ReferenceId": 43, "EdgeType": "queue", "SummaryStatistics": _stats(70, 7.75, faults=(6, 4))},
    ]}
    cart = {"ReferenceId": 41, "Name": "cart", "Type": "api", "Edges": [{"ReferenceId": 42, "SummaryStatistics": _stats(300, errors=(1, 1), faults=(2, 2))}]}
    draft = {"ReferenceId": 42, "Name": "stock-draft", "Edges": [{"ReferenceId": 40, "SummaryStatistics": {}}]}
    stock = {"ReferenceId": 42, "Name": "stock", "Type": "db", "State": 'a"b', "Names": ["stock", "s2"]}
    mail = {"ReferenceId": 43, "Name": "mail"}
    pages_given = [{"Services": [front, draft], "NextToken": "x"}, {"Services": [cart], "NextToken": "y"}, {"Services": [stock, mail]}]
    found = graph.service_dependencies(_graph(spark, *pages_given), "-2d", "-1d", now=NOW)
    assert found.schema.simpleString() == schemas.SERVICE_EDGES.simpleString()
    rows = {(r.source_service, r.target_service): r for r in found.collect()}
    assert set(rows) == {("front", "cart"), ("front", "stock"), ("front", "mail"), ("cart", "stock"), ("stock-draft", "front")}
    counts = {pair: (r.request_count, r.error_count, r.fault_count, r.throttle_count, r.total_response_time_seconds) for pair, r in rows.items()}
    assert counts[("front", "cart")] == (900, 8, 0, 5, 45.0) and counts[("front", "mail")] == (70, 0, 6, 4, 7.75)
    assert counts[("front", "stock")] == (None,) * 5 and counts[("cart", "stock")] == (300, 1, 2, 3, 0.5)
    assert counts[("stock-draft", "front")] == (0, 0, 0, 0, 0.0)
    assert rows["front", "mail"].edge_type == "queue" and rows["front", "cart"].edge_type == "synchronous"
    assert rows["cart", "stock"].target_attributes == '{"State":"a\\"b","Names":["stock","s2"]}' and rows["cart", "stock"].target_type == "db"
    assert rows["front", "mail"].target_type is None and rows["front", "cart"].source_attributes == '{"AccountId":"9"}'
    assert {(str(r.window_start), str(r.window_end)) for r in rows.values()} == {("2024-01-29 00:00:00", "2024-01-30 00:00:00")}


def test_pages_after_the_end_of_a_graph_are_not_judged(spark):
    given = _graph(spark, {"Services": [{"Name": "a", "Edges": [{"Aliases": [{"Name": "b"}]}]}]}, "no page at all")
    assert [r.target_service for r in graph.service_dependencies(given, now=NOW).collect()] == ["b"]


def test_aliases(spark):
    body = {
        "Services": [
            {"Name": "nameless", "Type": "t"},
            {"ReferenceId": 7, "Name": "", "Edges": [
                {"ReferenceId": 99, "EdgeType": "e", "Type": "f", "Aliases": [{"Name": "outside", "Type": "remote"}, {"Name": "b"}]},
                {"Type": "f", "Aliases": [{"Name": "named-by-alias"}], "StartTime": 5},
                {"ReferenceId": 7, "Aliases": [{"Name": "not used"}], "SummaryStatistics": {}},
            ]},
        ]
    }
    rows = {r.edge_type: r for r in graph.service_dependencies(_graph(spark, body), now=NOW).collect()}
    assert rows["e"].target_service == "outside" and rows["e"].target_type == "remote" and rows["e"].request_count is None
    assert rows["e"].edge_attributes == '{"Aliases":[{"Name":"outside","Type":"remote"},{"Name":"b"}]}'
    assert rows["f"].target_service == "named-by-alias" and rows["f"].target_attributes is None
    assert rows["f"].edge_attributes == '{"Aliases":[{"Name":"named-by-alias"}],"StartTime":5}'
    # A match counts even when the service has no name.
    assert rows["synchronous"].target_service is None and rows["synchronous"].request_count == 0


def test_bad_graph_pages(spark):
    for bad in ("[1]", "{"):
        with pytest.raises(Exception, match="not a JSON object"):
            graph.service_dependencies(_graph(spark, bad), now=NOW).collect()
    assert graph.service_dependencies(_graph(spark, {}), now=NOW).collect() == []


# Ragged results


def _responses(spark, *bodies):
    return results.decode_results(
        spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "response_no long, body string")
    )


def test_ragged_rows(spark):
    def pairs(*items):
        return [{k: v for k, v in zip(("field", "value"), item) if v is not None} for item in items]

    body = {
        "status": "Complete",
        "results": [
            pairs(("service_name", "a"), ("events", "1"), ("events", "2")),
            pairs(("service_name", "b"), (None, "lost"), ("@x.y", None)),
            [],
        ],
        "statistics": {"recordsMatched": 7.0, "recordsScanned": 93.0},
    }
    given = _responses(spark, body)
    table = results.tabulate_results(given)
    assert table.columns == ["service_name", "events", "@x.y"]
    assert {tuple(r) for r in table.collect()} == {("a", "2", None), ("b", None, ""), (None, None, None)}
    assert tuple(results.result_statistics(given).first()) == (0, 7, 93)
    with pytest.raises(ValueError, match="more than 2"):
        results.tabulate_results(given, max_columns=2)


def test_no_fields_give_the_message_column(spark):
    table = results.tabulate_results(_responses(spark, {"status": "Complete", "results": []}))
    assert table.columns == ["@message"] and table.count() == 0


@pytest.mark.parametrize("status", ["Running", "Scheduled", "Failed", "SomethingNew", ""])
def test_incomplete_results_raise(spark, status):
    with pytest.raises(Exception, match=f"did not complete: {status}"):
        results.result_statistics(_responses(spark, {"status": status, "results": []})).collect()


def test_query_limits():
    results.check_query(["g"], 10_000)
    for groups, rows in [([], 1), (["g"] * 51, 1), ([""], 1), (["g"], 10_001), (["g"], -1)]:
        with pytest.raises(ValueError):
            results.check_query(groups, rows)


# Names


def test_attached_names(spark, tmp_path):
    events = spark.createDataFrame([("/App", "s", NOW - 1000, 0, "1", "hello")], schemas.RAW_EVENTS)
    registry = spark.createDataFrame([("/App", None, None, 1), ("/App", "s", None, 1)], schemas.REGISTRY)
    events.write.parquet(str(tmp_path / "e"))
    registry.write.parquet(str(tmp_path / "r"))
    paths = {"events": str(tmp_path / "e"), "registry": str(tmp_path / "r")}
    attached = catalog.attach(spark, paths, now=NOW)
    assert attached.names() == ["logs./App"]
    assert spark.sql("SELECT body FROM `logs./App`").first().body == "hello"
    assert attached.table("LOGS./APP").count() == 1
    with pytest.raises(KeyError):
        attached.table("logs./other")
    assert catalog.attach(spark, paths, ["/b", "/a", "/b"], now=NOW).names() == ["logs./b", "logs./a"]
    for groups, options in [(["", "a"], {}), ([None], {}), (["a"], {"page_size": 5})]:
        with pytest.raises(ValueError):
            catalog.attach(spark, paths, groups, **options)


CHAINS = "request_id string, token_in string, next_token string, body string"


def _placed(spark, rows):
    found = pages.order_pages(spark.createDataFrame(rows, CHAINS)).collect()
    return sorted((r.request_id or "", r.page_no, r.body) for r in found)


def test_pages_are_put_in_order_by_their_tokens_alone(spark):
    rows = [("one", None, "", "a"), ("two", "", "x", "b"), ("two", "x", None, "c")]
    rows += [("ring", "", "p", "r0"), ("ring", "p", "q", "r1"), ("ring", "q", "s", "r2"), ("ring", "s", "p", "r3"), ("ring", "o", "p", "before")]
    rows += [("self", "", "k", "s0"), ("self", "k", "k", "s1"), ("lost", "z", "", "no first page"), (None, "", "n", "n0"), (None, "n", "", "n1")]
    rows += [("gap", "", "g", "g0"), ("gap", "h", "", "g2"), ("twice", "", "t", "least"), ("twice", "", "u", "more"), ("twice", "t", "", "end"), ("twice", "t", "", "end")]
    assert _placed(spark, rows) == sorted([
        ("one", 0, "a"), ("two", 0, "b"), ("two", 1, "c"), ("ring", 0, "r0"), ("ring", 1, "r1"), ("ring", 2, "r2"), ("ring", 3, "r3"),
        ("self", 0, "s0"), ("self", 1, "s1"), ("", 0, "n0"), ("", 1, "n1"), ("gap", 0, "g0"), ("twice", 0, "least"), ("twice", 1, "end"),
    ])
    assert _placed(spark, []) == []


def test_long_chains_are_ordered_like_a_walk(spark):
    rng = random.Random(4)
    rows, want = [], []
    for request, size in (("long", 3000), ("short", 5), ("mid", 129)):
        names = rng.sample(range(10**6), size)
        tokens = ["", *(f"t{n}" for n in names[1:]), f"t{names[size // 2]}" if size > 1 else ""]
        for i in range(size):
            rows.append((request, tokens[i], tokens[i + 1], str(i)))
            want.append((request, i, str(i)))
    rng.shuffle(rows)
    assert _placed(spark, rows) == sorted(want)


def test_pages_whose_chain_has_ended_take_part_in_no_later_round(spark, monkeypatch):
    """One long chain among many short ones: the short ones' places are written once or twice, not every round."""
    sizes, whole = [], pages.pin

    def counted(rows, purpose):
        made = whole(rows, purpose)
        sizes.append((purpose, made.count()))
        return made

    monkeypatch.setattr(pages, "pin", counted)
    rows = [("long", f"t{i}" if i else "", f"t{i + 1}", str(i)) for i in range(100)]
    rows += [(f"s{r}", "" if i == 0 else str(i), str(i + 1) if i < 2 else "", str(i)) for r in range(200) for i in range(3)]
    assert len(_placed(spark, rows)) == 700
    assert sum(n for purpose, n in sizes if purpose == "page-places") < 200 * (1 + 2 + 3) + 400


def test_wide_rows_are_not_searched_once_a_column(spark):
    """Each pair is placed once: the plan has no lookup per column, and values are those of plain Python."""
    rng = random.Random(5)
    names = ["n%d" % i for i in range(30)] + ["N1", "a b", "a.b", "", None]
    made = [[(rng.choice(names), rng.choice(["x", "", None, "é", str(i)])) for _ in range(rng.randrange(9))] for i in range(200)]
    rows = [(i, "Complete", [pairs, pairs[:1]]) for i, pairs in enumerate(made)]
    responses = spark.createDataFrame(rows, "response_no long, status string, results array<array<struct<field:string,value:string>>>")
    found = results.tabulate_results(responses, keep=["response_no"])
    assert "element_at" not in found._jdf.queryExecution().executedPlan().toString()
    seen = list(dict.fromkeys(n for pairs in made for n, _ in pairs if n is not None))
    assert found.columns == ["response_no", *seen]
    want = []
    for i, _, both in rows:
        for pairs in both:
            last = {n: v or "" for n, v in pairs if n is not None}
            want.append((i, *(last.get(n) for n in seen)))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    named = spark.createDataFrame([(1, "Complete", [[("response_no", "x")]])], responses.schema)
    assert tuple(results.tabulate_results(named, keep=["response_no"]).first()) == (1, "x")


# Table functions


@pytest.fixture(scope="module")
def functions(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("functions")
    rows = [(g, f"s{i % 3}", NOW - i * 3_600_000, NOW - i * 3_600_000 + 1, str(i), f"line {i % 5}") for g in ("/a", "/b") for i in range(1, 100)]
    tables.append_events(spark.createDataFrame(rows, schemas.RAW_EVENTS), str(root / "e"))
    points = [("n", m, NOW - i * 60_000, float(i), "None", {}) for m in ("x", "y") for i in range(1, 50)]
    tables.append_metrics(spark.createDataFrame(points, schemas.RAW_METRICS), str(root / "m"))
    names = table_functions.register(spark, {"events": str(root / "e"), "metrics": str(root / "m")}, region="r", now=NOW)
    assert names == ["read_logs", "read_metrics"]
    return spark


def test_logs_by_named_arguments(functions):
    found = functions.sql("SELECT * FROM read_logs(log_group => '/a', start_time => '-1d', end_time => '-2h')")
    assert found.schema.simpleString() == schemas.OTLP_LOGS.simpleString() and found.count() == 22
    assert functions.sql("SELECT * FROM read_logs('/a')").count() == 0
    both = functions.sql("SELECT * FROM read_logs(log_group => '/a', start_time => '2024-01-30', filter => ' \"line 2\" ', log_stream_prefix => 's1')")
    assert {r.body for r in both.collect()} == {"line 2"} and both.count() == sum(1 for i in range(1, 25) if i % 5 == 2 and i % 3 == 1)
    listed = functions.sql(f"SELECT * FROM read_logs(log_group => '/b', start_time => '{NOW - 10 * 3_600_000}', log_streams => array('s0', 's2'))")
    assert listed.count() == sum(1 for i in range(1, 11) if i % 3 != 1)


def test_arguments_reach_the_scan(functions):
    plan = functions.sql("SELECT body FROM read_logs(log_group => '/a', start_time => '-1d')")._jdf.queryExecution().executedPlan().toString()
    filters, pushed = plan[plan.index("PartitionFilters") :].split("PushedFilters")
    assert "event_date" in filters and "EqualTo(log_group,/a)" in pushed
    assert "ingestion_time_ms" not in plan and "Union" not in plan


@pytest.mark.parametrize("call, reason", [
    ("read_logs(log_group => '')", "name a log group"), ("read_logs(log_group => '/a', start_time => 'soon')", "a time has to be"),
    ("read_logs(log_group => '/a', start_time => 'now', end_time => '-1h')", "start lies after"), ("read_logs(log_group => '/a', filter => 'a b')", "single term"),
    ("read_logs(log_group => '/a', filter => '{x}')", "quoted phrase"), ("read_logs(log_group => '/a', log_stream_prefix => 's', log_streams => array('s'))", "not both"),
    ("read_metrics(namespace => 'n', metric_name => '')", "name a namespace"), ("read_metrics(namespace => 'n', metric_name => 'x', statistic => 'p9')", "has to be one of"),
    ("read_metrics(namespace => 'n', metric_name => 'x', period => 0)", "period"),
])
def test_bad_arguments_raise(functions, call, reason):
    with pytest.raises(Exception, match=reason):
        functions.sql(f"SELECT * FROM {call}").collect()


def test_metrics_by_named_arguments(functions):
    found = functions.sql("SELECT * FROM read_metrics(namespace => 'n', metric_name => 'x', period => 600, statistic => 'SampleCount') ORDER BY 1").collect()
    assert sum(r.double_value for r in found) == 49 and {r.name for r in found} == {"x"} and found[0].unit is None
    mean = functions.sql("SELECT * FROM read_metrics(namespace => 'n', metric_name => 'y', start_time => '-10m', period => 3600)").collect()
    assert [r.double_value for r in mean] == [sum(range(1, 10)) / 9]
