"""CHART incident XML decoder.

An incident is any element whose tag, lower-cased, ends with ``incident``
(``Incident``, ``incident``, ``TrafficIncident``; not the ``Incidents``
root) and that has child elements.  A document is read in one scan over its
elements without markup inside (one event each) and its other tags.  A running
sum of opened minus closed tags gives the depth after each other tag; sorting
these by (depth, place) puts the ends of an element's children right behind its
start, and the events after each of them, up to the next, are its children.
All of it is array expressions in the document's own row; work grows with the
document times the logarithm of its number of tags, however incidents nest.

Child tags match exactly (case, prefix) and only as direct children; of a
repeated child the first counts; a field's text ends where markup inside it
begins.  The usual document, incidents one after another whose children hold
text alone, is told by what is left without them and needs no scan.  Comments and processing instructions are dropped, CDATA sections are
read as escaped text before anything else looks at the markup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.arrays import let, running, running_sum
from roadlake.schemas import INCIDENT_TAGS

_FIELDS = [tag for tag, _ in INCIDENT_TAGS]
# Names and attributes; quoted attribute values may hold ">". Possessive: no retries.
_TAG = r"""[A-Za-z_:][^\s/>]*+"""
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# An element without markup inside, or any tag.
_LEAF = rf"<({_TAG}){_ATTRIBUTES}(?<!/)>([^<]*+)</\1\s*+>"
_EVENT = rf"{_LEAF}|</?{_TAG}{_ATTRIBUTES}>"
_NAME = rf"^</?({_TAG})"
# An incident without attributes, of plain children; an opened or empty child.
_PLAIN = (r"<([A-Za-z]{0,32}?(?i:incident))>((?:\s*+<([A-Za-z_]\w*+)(?:/>|>[^<]*+</\3>)){1,64}+\s*+)</\1>")
_CHILD = r"<([^\s/>]++)(?:/>|>([^<]*+))"
# What plain incidents, each read as a line's end, leave of a plain document.
_REST = (r"^(?:<\?xml [^<>?\n]*+\?>)?\s*+<((?!\w*?(?i:incident)>)[A-Za-z_]\w*+)>"
         r"(?:\s*+<[A-Za-z_]\w*+/>){0,64}+\s*+</\1>\s*+$")
_SILENT = r"(?s)<!--.*?-->|<\?.*?\?>"
_CDATA = "<![CDATA["


def _without_cdata(value: Column) -> Column:
    """The document with each CDATA section as escaped text."""
    parts = F.split(value, r"<!\[CDATA\[")

    def escaped(part, i):
        end = F.instr(part, F.lit("]]>"))
        return F.when((i == 0) | (end == 0), part).otherwise(
            F.concat(xml_escape(F.substr(part, F.lit(1), end - 1)), F.substr(part, end + 3)))

    return F.when(value.contains(_CDATA), F.array_join(F.transform(parts, escaped), "")).otherwise(value)


def xml_unescape(s: Column) -> Column:
    """Text of an XML element body: named and numeric references decoded in
    one pass, others left as they are."""
    def reference(part, i):
        name = F.substring_index(part, ";", 1)
        code = F.when(name.rlike("^#x[0-9A-Fa-f]{1,6}$"), F.conv(F.substr(name, F.lit(3)), 16, 16)) \
            .when(name.rlike("^#[0-9]{1,7}$"), F.conv(F.substr(name, F.lit(2)), 10, 16))
        known = (F.when(name == "lt", "<").when(name == "gt", ">").when(name == "amp", "&")
                 .when(name == "quot", '"').when(name == "apos", "'")
                 .when(code.isNotNull(), F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")))
        plain = (i == 0) | ~part.contains(";") | known.isNull()
        return F.when(i == 0, part).when(plain, F.concat(F.lit("&"), part)) \
            .otherwise(F.concat(known, F.substr(part, F.length(name) + 2)))

    return F.when(s.contains("&"), F.array_join(F.transform(F.split(s, "&"), reference), "")).otherwise(s)


def _events(value: Column) -> Column:
    """Elements without markup inside and other tags of a document in its
    order: ``name``, ``step`` (1 opens, -1 closes, 0 both) and ``text`` up to
    the next tag."""
    plain = F.regexp_replace(_without_cdata(value), _SILENT, "")

    def event(texts, tag, i):
        # most tags have no attributes: their name ends at the first ">"
        head, close = F.substring_index(tag, ">", 1), tag.startswith("</")
        bare = ~head.rlike(r"""[\s"']""")
        leaf, alone = ~close & tag.contains("</"), tag.endswith("/>")
        name = F.when(bare & close, F.substr(head, F.lit(3))) \
            .when(bare & ~alone, F.substr(head, F.lit(2))).otherwise(F.regexp_extract(tag, _NAME, 1))
        body = F.when(bare, F.substring_index(F.substr(tag, F.length(head) + 2), "</", 1)) \
            .otherwise(F.regexp_extract(tag, _LEAF, 2))
        return F.struct(name.alias("name"), F.when(close, -1).when(leaf | alone, 0).otherwise(1).alias("step"),
                        F.when(leaf, body).when(alone, F.lit("")).otherwise(F.get(texts, i + 1)).alias("text"))

    return let(plain, lambda p: let(F.split(p, _EVENT, -1), lambda texts: F.transform(
        F.regexp_extract_all(p, F.lit(_EVENT), F.lit(0)), lambda tag, i: event(texts, tag, i))))


def incident_elements(value: Column) -> Column:
    """Incident elements of one XML document, in its order (nested ones of
    any depth included): array of struct(pos, names, texts), the tags and raw
    texts of the element's children.  Elements that a damaged document never
    closes are left out."""
    def bounds(ev):
        # tags that open or close around others, each with the place after its
        # last event before the next (an opened child belongs to them)
        tags = F.filter(F.transform(ev, lambda e, i: F.when(e["step"] != 0, F.struct(
            i.alias("pos"), e["name"].alias("name"), e["step"].alias("step")))), lambda t: t.isNotNull())
        return let(tags, lambda s: let(running_sum(F.transform(s, lambda t: t["step"])), lambda depth: found(ev, s, depth)))

    def found(ev, tags, depth):
        def place(t, k):
            after = F.get(tags, k + 1)
            end = F.coalesce(after["pos"] + F.when(after["step"] == 1, 1).otherwise(0), F.size(ev))
            return F.struct(F.get(depth, k).alias("depth"), k.alias("k"), t["pos"].alias("pos"), end.alias("end"),
                            t["step"].alias("step"), t["name"].alias("name"))

        return let(F.array_sort(F.transform(tags, place)), lambda order: kept(ev, depth, order))

    def kept(ev, depth, order):
        starts = F.filter(F.transform(order, lambda o, q: F.when(o["step"] == 1, q)), lambda q: q.isNotNull())

        def element(starts_of, q, k):
            own = F.slice(order, q + 1, F.coalesce(F.get(starts_of, k + 1), F.size(order)) - q)
            children = F.flatten(F.transform(own, lambda o: F.slice(ev, o["pos"] + 2, o["end"] - o["pos"] - 1)))
            head = F.get(order, q)
            return let(children, lambda c: F.struct(
                head["pos"].alias("pos"), head["depth"].alias("depth"), head["k"].alias("k"),
                F.transform(c, lambda e: e["name"]).alias("names"), F.transform(c, lambda e: e["text"]).alias("texts")))

        mine = let(starts, lambda at: F.filter(
            F.transform(at, lambda q, k: F.when(F.lower(F.get(order, q)["name"]).endswith("incident"), element(at, q, k))),
            lambda x: x.isNotNull() & (F.size(x["names"]) > 0)))
        # only a damaged document ends inside an element
        later = F.when(F.element_at(depth, -1) > 0, F.reverse(running(F.reverse(depth), F.least)))
        closed = let(later, lambda low: F.filter(mine, lambda x: low.isNull() | (F.get(low, x["k"]) < x["depth"])))
        return F.array_sort(F.transform(closed, lambda x: F.struct(x["pos"], x["names"], x["texts"])))

    return let(_events(value), lambda ev: F.when(F.exists(ev, lambda e: e["step"] != 0), bounds(ev)))


def _plain_elements(value: Column) -> Column:
    """As :func:`incident_elements`, without pos, for a plain document."""
    return F.transform(F.regexp_extract_all(value, F.lit(_PLAIN), F.lit(2)), lambda body: F.struct(
        F.regexp_extract_all(body, F.lit(_CHILD), F.lit(1)).alias("names"),
        F.regexp_extract_all(body, F.lit(_CHILD), F.lit(2)).alias("texts")))


def xml_explode(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per incident element: ``pos`` and ``x`` (struct of the child
    texts named by their tags; absent children are null, empty ones '')."""
    keep = [c for c in docs.columns if c != value_col]
    value = F.col(value_col)
    scanned = F.transform(incident_elements(value), lambda e: F.struct(e["names"].alias("names"), e["texts"].alias("texts")))
    plain = F.regexp_replace(value, _PLAIN, "\n").rlike(_REST)
    rows = docs.select(*keep, F.posexplode(F.when(plain, _plain_elements(value)).otherwise(scanned)).alias("pos", "e"))

    def field(tag):
        at = F.array_position("e.names", tag).cast("int")
        return xml_unescape(F.get("e.texts", at - 1)).alias(tag)

    return rows.select(*keep, "pos", F.struct(*[field(tag) for tag in _FIELDS]).alias("x"))


def incident_count(value: Column) -> Column:
    """Number of incident elements in a document."""
    return let(incident_elements(value), lambda e: F.when(e.isNull(), 0).otherwise(F.size(e)))


def xml_escape(s: Column) -> Column:
    """Escape text for an XML element body."""
    return F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def read_incident_xml(spark, path: str, row_tag: str = "Incident"):
    """Large incident XML files through Spark's XML reader: each ``row_tag``
    element is a row (files are split across tasks), parsed against the
    same text-field schema -> ``snapshot``, ``snapshot_ms``, ``x``.

    Of a repeated child the first counts.  Unlike :func:`xml_explode` the row
    tag is one exact name (no suffix or case rule), incidents inside others
    are not rows, and elements without any known child are dropped."""
    schema = ", ".join(f"{tag} array<string>" for tag in _FIELDS)
    rows = (spark.read.format("xml").option("rowTag", row_tag)
            .option("ignoreSurroundingSpaces", "false").schema(schema).load(path))
    known = F.lit(False)
    for tag, _ in INCIDENT_TAGS:
        known = known | F.col(tag).isNotNull()
    return rows.where(known).select(
        F.col("_metadata.file_path").alias("snapshot"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("snapshot_ms"),
        F.struct(*[F.get(tag, F.lit(0)).alias(tag) for tag in _FIELDS]).alias("x"))
