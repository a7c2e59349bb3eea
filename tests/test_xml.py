"""The tag scan against a tree parser: nested, repeated, mixed, CDATA,
comments, prefixes, references; damaged and long documents."""

import random
import time
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from roadlake.schemas import INCIDENT_TAGS
from roadlake.sources.xml import incident_count, read_incident_xml, xml_explode

FIELDS = [t for t, _ in INCIDENT_TAGS]


def from_tree(text):
    """Incidents in document order: the text before the first child of each
    field's first element, None for absent or empty."""
    return [tuple((e.find(t).text or None) if e.find(t) is not None else None for t in FIELDS)
            for e in ET.fromstring(text).iter() if e.tag.lower().endswith("incident") and len(e)]


def decoded(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, value string").repartition(4)
    out = {i: [] for i in range(len(texts))}
    for r in sorted(xml_explode(df).collect(), key=lambda r: (r.doc, r.pos)):
        out[r.doc].append(tuple(r.x[t] or None for t in FIELDS))
    return out


def made(rng, depth=0):
    """A random element tree as text."""
    words = ["a", "b &amp; c", "&lt;x&gt;", "&#233;&#x1F600;", "x &amp;lt; y", "<![CDATA[</Incident> & <b>]]>", "<!-- <id>no</id> -->",
             "<?go <id>1</id>?>", " ", "&quot;q&apos;", "<b>bold</b> after", "\n"]
    parts = []
    for _ in range(rng.randrange(6)):
        tag = rng.choice([*FIELDS[:6], "ID", "note", "Incident", "trafficIncident", "incident", "IncidentX", "Wrap"])
        attrs = rng.choice(["", "", ' k="v"', " k='a > b'", ' k="/"'])
        if rng.random() < .15:
            parts.append(f"<{tag}{attrs}{rng.choice(['', ' '])}/>")
        else:
            inner = made(rng, depth + 1) if depth < 5 and tag not in FIELDS and rng.random() < .7 else ""
            parts.append(f"<{tag}{attrs}>{rng.choice(words)}{rng.choice(words)}{inner}</{tag}{rng.choice(['', ' '])}>")
    return "".join(parts)


def test_random_documents_equal_a_tree_parser(spark):
    rng = random.Random(7)
    texts = [f'<?xml version="1.0"?><!DOCTYPE r><r>{made(rng)}{made(rng)}</r>' for _ in range(400)]
    texts += ["<Incident><id>1</id></Incident>", "<r/>", "<r>text</r>", "<u:r xmlns:u='x'><u:Incident><u:id>1</u:id><id>2</id></u:Incident></u:r>"]
    got = decoded(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == from_tree(t), t
    assert sum(map(len, got.values())) > 400


def test_deep_nesting_lists_every_incident(spark):
    deep = "<r>" + "".join(f"<Incident><id>{i}</id>" for i in range(200)) + "</Incident>" * 200 + "</r>"
    assert [x[0] for x in decoded(spark, [deep])[0]] == [str(i) for i in range(200)]


def test_damaged_documents_and_no_text(spark):
    texts = [None, "", "no markup", "<r><Incident><id>1</id></Incident><Incident><id>2</id>", "</r></Incident>",
             "<r><Incident><id>1</id><cou", "<r>&#1114112;<Incident><id>&nope; &#60; a&b</id></Incident></r>"]
    got = decoded(spark, texts)
    assert [[x[0] for x in got[i]] for i in range(7)] == [[], [], [], ["1"], [], [], ["&nope; < a&b"]]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r[0] for r in df.select(incident_count(F.col("value"))).collect()] == [0, 0, 0, 1, 0, 0, 1]


def test_one_nested_incident_costs_a_large_document_little(spark):
    flat = "".join(f"<Incident><id>{i}</id><county>c</county><lat>1.5</lat></Incident>" for i in range(20_000))
    nested = "<Incident><id>x</id><Incident><id>y</id></Incident></Incident>"
    seconds = []
    for text in (f"<r>{flat}</r>", f"<r>{nested}{flat}</r>"):
        df = spark.createDataFrame([(text,)], "value string")
        began = time.time()
        n = xml_explode(df).agg(F.count("x.id")).first()[0]
        seconds.append(time.time() - began)
        assert n in (20_000, 20_002)
    assert seconds[1] < 5 * seconds[0] + 5


def test_both_readers_take_the_first_of_repeated_children(spark, tmp_dir):
    text = ("<Incidents><Incident><id>1</id><county>a</county><county>b</county><!-- <id>9</id> --><lat/></Incident>\n"
            "<Incident><id>2</id><description><![CDATA[x </y> & z]]></description><county>c</county></Incident></Incidents>")
    with open(f"{tmp_dir}/f.xml", "w") as f:
        f.write(text)
    rows = [tuple(r.x[t] or None for t in FIELDS) for r in read_incident_xml(spark, tmp_dir).collect()]
    assert sorted(rows, key=lambda r: r[0]) == decoded(spark, [text])[0] == from_tree(text)
