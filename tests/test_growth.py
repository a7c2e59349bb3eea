"""Steps that the day reports' time grows with."""

import pytest
from pyspark.sql import functions as F

from roadlake.functions.geo import line_endpoints
from roadlake.plans import feeds, queries as Q
from roadlake.sources import xml

SF = "/root/testdata/sf0.001"
ONE = "<Incident><id>1</id><county>A &amp; B</county><lat/></Incident>"
DOCS = [f"<Incidents>{ONE}</Incidents>", f'<?xml version="1.0"?>\n<Incidents>\n {ONE}\n{ONE.replace("Incident", "trafficINCIDENT")}<Incident/> </Incidents>\n',
        ONE, f"<Incident>{ONE}</Incident>", f"<Incidents>{ONE}text{ONE}</Incidents>", f"<Incidents><!-- {ONE} -->{ONE}</Incidents>",
        f"<Incidents><![CDATA[{ONE}]]>{ONE}</Incidents>", f"<Incidents>{ONE}", f"<Inci{ONE}dents></Incidents>", f'<Incidents a="{ONE}">{ONE}</Incidents>',
        f"<Incidents><Incident>x<id>2</id>\n<id>3</id></Incident>{ONE}</Incidents>", "<Incidents></Incidents>", "<Incidents><Incident></Incident></Incidents>",
        "<Incidents><Incident> <id>4</id ><b><id>5</id></b></Incident></Incidents>", "<Incidents><Incident><id>a>b</id>\n<Incident>6</Incident></Incident></Incidents>",
        "<I><Incident>" + "<id>7</id>" * 80 + "</Incident></I>", "<I>" + ONE * 5000 + "</I>", f"<I>{ONE}</J>", f"<?xml {ONE}?><I>{ONE}</I>", "", None]


def test_plain_documents_read_as_the_scan_reads_them(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(DOCS)), "doc int, value string")
    read = lambda: sorted((r.doc, r.pos, str(r.x)) for r in xml.xml_explode(df).collect())
    got = read()
    monkeypatch.setattr(xml, "_REST", "(?!)")
    assert got == read() and len(got) > 5000


def test_the_feeds_documents_need_no_scan(spark):
    docs = feeds.incident_snapshots(feeds.table(spark, SF, "events"), feeds.table(spark, SF, "nation"))
    assert docs.where(~F.regexp_replace("value", xml._PLAIN, "\n").rlike(xml._REST)).isEmpty()


def test_incremental_incidents_are_decoded_once(spark, monkeypatch):
    class Seen(Exception):
        pass

    def landed(records, *a, **k):
        raise Seen(records._jdf.queryExecution().analyzed().toString())

    monkeypatch.setattr(Q, "write_landing", landed)
    with pytest.raises(Seen) as seen:
        Q.zones_incremental_county_performance(spark, SF)
    assert "Generate" not in str(seen.value)


def test_wide_projections_stay_compiled(spark):
    Q.queries()["wzdx_snapshot_check"](spark, SF)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def plain_endpoints(kind, c):
    """By plain rules: (begin, end) positions."""
    ok = lambda p: isinstance(p, list) and len(p) == 2
    if not isinstance(c, list) or not c or kind not in ("LineString", "MultiLineString"):
        return None, None
    first, last = (c, c) if kind == "LineString" else (c[0], c[-1])
    begin = first[0] if isinstance(first, list) and first else "none"
    if begin != "none" and not ok(begin):
        return None, None
    end = last[-1] if isinstance(last, list) and last else None
    typed = lambda p: [x if isinstance(x, int | float) else None for x in p]
    return (None if begin == "none" else typed(begin)), (typed(end) if ok(end) else None)


def test_only_the_end_positions_are_typed(spark):
    import json
    values = [[[1, 2], [3, 4.5]], [[1, 2, 3], [4, 5]], [[1, 2], [4, 5, 6]], [], [[]], [[], [[1, 2]]], [[[1, 2], [3, 4]], [[5, 6], [7, 8]]],
              [[[1, 2, 3]], [[5, 6]]], [[[1, 2]], []], [1, 2], "x", None, {"a": 1}, [None, [1, 2]], [[1, 2], None], [[[1, 2]], None]]
    cases = [(k, json.dumps(v)) for k in ("LineString", "MultiLineString", "Point") for v in values] + [(None, "[[1,2]]")]
    df = spark.createDataFrame(cases, "kind string, c string")
    ends = line_endpoints(F.col("kind"), F.parse_json("c"))
    plan = df.select(ends.alias("e"))
    assert "array<array<" not in plan._jdf.queryExecution().analyzed().toString()
    for r in df.select("*", ends.alias("e")).collect():
        begin, end = plain_endpoints(r.kind, json.loads(r.c))
        want = (*(reversed(begin) if begin else (None, None)), *(reversed(end) if end else (None, None)))
        assert (tuple(r.e) if r.e is not None else (None,) * 4) == want, (r.kind, r.c)
