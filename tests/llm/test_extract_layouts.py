"""Main text on layouts that the training pages do not have, unclosed elements, long pages."""

from __future__ import annotations

import random
import tracemalloc

import pytest

from roadlake.llm import extract


def prose(rng, n=45):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(n)).capitalize() + "."


NAV = "<div><ul>" + "".join(f"<li><a href='/{i}'>Topic {i}</a></li>" for i in range(7)) + "</ul></div>"
FOOT = "<footer><p>Copyright notice of the site</p></footer>"


def page(kind, rng):
    """A page of a layout family, the article's blocks and the other blocks."""
    text = [prose(rng) for _ in range(rng.randint(4, 14))]
    p = "".join(f"<p>{t}</p>" for t in text)
    inner = {
        "columns": lambda: f"<div class='container-fluid'><div class='row'><div class='col-md-8 col-xs-12'>{p}</div></div></div>",
        "hashed names": lambda: f"<div class='css-1q2w3e'><div class='sc-bdVaJa kZxT'>{p}</div></div>",
        "no container": lambda: p,
        "table cell": lambda: f"<table width=100%><tr><td valign=top>{p}</td></tr></table>",
        "bare lines": lambda: "<table><tr><td>" + "<hr>".join(text) + "</td></tr></table>",
        "one div a paragraph": lambda: "<div class='row'>" + "".join(f"<div>{t}</div>" for t in text) + "</div>",
        "data table": lambda: f"<article>{p}<table>" + "".join(f"<tr><td>{t}</td><td>{len(t)}</td></tr>" for t in text) + "</table></article>",
        "definitions": lambda: f"<main>{p}<dl>" + "".join(f"<dt>{t[:12]}</dt><dd>{t}</dd>" for t in text) + "</dl></main>",
        "figures": lambda: "<div class='story'>" + "".join(f"<p>{t}</p><figure><img src=a><figcaption>{t[:60]}</figcaption></figure>"
                                                          for t in text) + "</div>",
    }[kind]()
    html = f"<html><body>{NAV}<h1>{text[0][:30]}</h1>{inner}<aside class='widget-area'><p>{prose(rng, 12)}</p></aside>{FOOT}</body></html>"
    return html, text


@pytest.mark.parametrize("kind", ["columns", "hashed names", "no container", "table cell", "bare lines", "one div a paragraph",
                                  "data table", "definitions", "figures"])
def test_recall_on_layout_families(kind):
    rng = random.Random(kind)
    made = [page(kind, rng) for _ in range(30)]
    got = extract.trained().texts([h for h, _ in made])
    found = sum(t in g.split("\n\n") for (_, text), g in zip(made, got) for t in text)
    assert found >= 0.9 * sum(len(text) for _, text in made)
    assert sum("Topic 3" in g or "Copyright notice" in g for g in got) <= 3


@pytest.mark.parametrize("part,shown", [
    ("<svg/>", True), ("<svg viewBox='0 0 1 1'><path d='M0'/></svg>", True), ("<svg><text>drawn", True),
    ("<div><svg><g></div>", True), ("<!-- x --!>", True), ("<!-->", True), ("<!--->", True),
    ("<select><option>pick</select>", True), ("<div><select><option>pick</div><select></select>", True), ("<select>", True),
    ("<noscript>", True), ("<noscript><div>on</div></noscript>", True), ("<iframe src=x>", True), ("<textarea>", True),
    ("<title>", True), ("<template><p>made</p></template>", True), ("<script>if (a < b) x()</script>", True),
    ("<style>", True), ("<script>", True), ("<script>var x = '<p>q</p>'</script>", True), ("<!-- open", False)])
def test_elements_that_are_not_text_hide_nothing_behind_them(part, shown):
    blocks = [b[0] for b in extract.Blocks(f"<p>before</p>{part}<p>behind it</p><p>last</p>").out]
    assert blocks[0] == "before"
    assert (blocks[-2:] == ["behind it", "last"]) == shown
    assert not {"pick", "on", "made", "q"} & set(blocks)


def test_hidden_parts_do_not_end_a_block():
    b = extract.Blocks("<p>one <svg><path/></svg>two <select><option>x</option></select>three</p><p>four</p>").out
    assert [x[0] for x in b] == ["one two three", "four"]


def test_many_unclosed_elements_take_linear_time():
    page_ = "<select><iframe><svg><title>" * 20_000 + "<p>end</p>"
    assert extract.Blocks(page_).out[-1][0] == "end"
    page_ = "<script>a</script><select><option>b</select>" * 20_000 + "<p>end</p>"
    assert [b[0] for b in extract.Blocks(page_).out] == ["end"]


def test_a_page_of_50000_blocks_stays_small():
    rng = random.Random(5)
    t = [prose(rng, 4) for _ in range(50)]
    html = "<article>" + "".join(f"<p>{t[i % 50]}</p>" for i in range(50_000)) + "</article>"
    model = extract.trained()
    tracemalloc.start()
    got = model.texts([html])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.count("\n\n") > 45_000
    assert peak < 500 << 20


def test_scores_do_not_depend_on_the_pages_beside(monkeypatch):
    rng = random.Random(6)
    made = [page(k, rng)[0] for k in ("columns", "figures", "definitions") for _ in range(6)] + ["", None, "<p>x"]
    whole = extract.trained().texts(made)
    monkeypatch.setattr(extract, "CELLS", 1)
    assert extract.trained().texts(made) == whole
