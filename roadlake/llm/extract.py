"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks. Each block's vector is the sum
of learned vectors of the tags, classes, ids and roles on its path, the mean of
learned vectors of its hashed words, and a few measures (length, link share,
marks). A bidirectional LSTM in numpy reads the sequence, so each block is
classed with the whole page in view; blocks classed as article are joined.

The network is trained on the driver on pages that ``training_page`` makes by
rule (articles among menus, headers, footers, sidebars, notices, adverts,
forms and comments, in several layouts and naming habits), with a fixed seed:
the weights depend on no input table.

Defined cases: null or empty html gives an empty text; unclosed, misnested and
unknown tags are read as far as they go; scripts, styles, comments, form
controls and the head's title never are text; one that is not closed hides
nothing behind it (an unclosed script ends at the next tag, an unclosed list of
options or drawing where its parent ends); character references are decoded; equal pages give equal texts; other columns pass through, clashing
result columns are replaced.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import drop_clashing, read

PATH_BINS, WORD_BINS, WIDTH, HIDDEN, MEASURES = 2048, 1024, 12, 16, 4
PAGES, EPOCHS, BATCH = 900, 14, 32
#: Blocks (with padding) that are scored at a time, one page's at least.
CELLS = 1 << 14

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|([^<]+|<)", re.S)
#: Elements whose content is no markup, and no text of a page.
RAW = frozenset("script style textarea title iframe".split())
CODE = frozenset("script style".split())
#: Elements with markup inside that is no text of a page.
UNSEEN = frozenset("noscript template select svg".split())
RAW_END = re.compile(r"</(script|style|textarea|title|iframe|noscript|template|select|svg)\b[^>]*>", re.I)
#: Opening tags that end an open drawing or list of options.
BREAKS = frozenset("address article aside blockquote body center details div dl dt dd fieldset figure footer form "
                   "h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table tbody td th thead tr ul".split())
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(r"[a-z]+")
#: Elements that do not end a block (HTML's phrasing elements).
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening block element ends.
LEFT_OPEN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}


class Blocks:
    """The blocks of one page: text, path (tuple of feature bins), link share."""

    def __init__(self, page: str):
        self.out: list[tuple[str, tuple[int, ...], float]] = []
        self.path: list[tuple[str, tuple[int, ...]]] = []
        self.places: dict[str, list[int]] = {}   # where on the path each name is open
        self.text: list[str] = []
        self.linked = 0
        in_link = 0
        hidden, inner = "", {}                   # the open hidden element, tags open inside it
        # end tags by name, the last one first
        ends: dict[str, list[tuple[int, int]]] = {}
        for m in RAW_END.finditer(page):
            ends.setdefault(m[1].lower(), []).append(m.span())
        for found in ends.values():
            found.reverse()

        def next_end(name: str, after: int) -> int:
            """Where the next end tag of ``name`` ends; 0: there is none."""
            found = ends.get(name, ())
            while found and found[-1][0] < after:
                found.pop()
            return found[-1][1] if found else 0

        at, size = 0, len(page)
        while at < size:
            m = TOKEN.match(page, at)
            at = m.end()
            name = m[2]
            if m[4] is not None:
                if hidden:
                    continue
                t = m[4] if "&" not in m[4] else html.unescape(m[4])
                self.text.append(t)
                if in_link:
                    self.linked += len(t)
                continue
            if name is None:
                continue
            name, opens = name.lower(), not m[1]
            if name in RAW:
                if opens:
                    end = next_end(name, at)
                    if not end and name in CODE:
                        end = page.find("<", at)
                        end = size if end < 0 else end
                    at = end or at
                continue
            if hidden:
                if opens:
                    if name in BREAKS and hidden in ("svg", "select"):
                        hidden = ""
                    else:
                        if name not in VOID and not m[3].endswith("/"):
                            inner[name] = inner.get(name, 0) + 1
                        continue
                elif inner.get(name):
                    inner[name] -= 1
                    continue
                elif name == hidden:
                    hidden = ""
                    continue
                elif self.places.get(name):
                    hidden = ""                     # the parent ends
                else:
                    continue
            if name in UNSEEN:
                if opens and not (name == "svg" and m[3].endswith("/")) and next_end(name, at):
                    hidden, inner = name, {}
                continue
            if name == "a":
                in_link = 1 if opens else 0
            if name in INLINE:
                if name == "br":
                    self.text.append(" ")
                continue
            self.end_block()
            if not opens:
                self.close(name)
                in_link = 0
            elif name not in VOID:
                self.open(name, m[3])
        self.end_block()

    def end_block(self) -> None:
        t = " ".join("".join(self.text).split())
        if t:
            self.out.append((t, self.path[-1][1] if self.path else (), min(1.0, self.linked / len(t))))
        self.text, self.linked = [], 0

    def open(self, name: str, attributes: str) -> None:
        if self.path and self.path[-1][0] == "p":
            self.pop()                             # a block ends an open paragraph
        for old in LEFT_OPEN.get(name, ()):
            if self.path and self.path[-1][0] == old:
                self.pop()
        # long attributes are read whole too, but not remembered
        bins = tag_bins(name, attributes) if len(attributes) < 400 else tag_bins.__wrapped__(name, attributes)
        above = self.path[-1][1] if self.path else ()
        self.places.setdefault(name, []).append(len(self.path))
        self.path.append((name, above + tuple(b for b in bins if b not in above)))

    def pop(self) -> None:
        self.places[self.path.pop()[0]].pop()

    def close(self, name: str) -> None:
        at = self.places.get(name)
        if at:
            for _ in range(len(self.path) - at[-1]):
                self.pop()


@lru_cache(maxsize=50_000)
def tag_bins(name: str, attributes: str) -> tuple[int, ...]:
    """Bins of an element: its tag, and the words of its class, id and role."""
    keys = [f"<{name}"]
    for m in NAMED.finditer(attributes):
        value = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "")
        keys += PART.findall(value.lower())
    return tuple(dict.fromkeys(zlib.crc32(k.encode()) % PATH_BINS for k in keys))


@lru_cache(maxsize=200_000)
def word_bin(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_BINS


def measures(text: str, linked: float) -> list[float]:
    n = len(text)
    return [min(1.0, n / 400), linked, min(1.0, sum(map(text.count, ".,;:!?")) / (1 + n / 20)), 1.0]


class Labeller:
    """Embeddings, two LSTMs and a logistic output."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        size = 2 * WIDTH + MEASURES

        def cell():
            w = rng.normal(0, 0.25, (size + HIDDEN, 4 * HIDDEN))
            b = np.zeros(4 * HIDDEN)
            b[HIDDEN:2 * HIDDEN] = 1.0                      # remember at first
            return w, b

        (wf, bf), (wb, bb) = cell(), cell()
        self.p = {"path": rng.normal(0, 0.15, (PATH_BINS, WIDTH)), "word": rng.normal(0, 0.05, (WORD_BINS, WIDTH)),
                  "wf": wf, "bf": bf, "wb": wb, "bb": bb, "out": rng.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}

    # a batch: path and word bins (flat, with the cell each belongs to), measures, mask
    @staticmethod
    def batch(pages: list[list[tuple[str, tuple[int, ...], float]]]):
        b, t = len(pages), max(map(len, pages))
        x = np.zeros((t, b, MEASURES))
        mask = np.zeros((t, b), bool)
        path, path_at, word, word_at, count = [], [], [], [], np.ones(t * b)
        for j, blocks in enumerate(pages):
            for i, (text, bins, linked) in enumerate(blocks):
                mask[i, j] = True
                x[i, j] = measures(text, linked)
                path += bins
                path_at += [i * b + j] * len(bins)
                w = [word_bin(v) for v in text.split()]
                word += w
                word_at += [i * b + j] * len(w)
                count[i * b + j] = max(1, len(w))
        ints = [np.array(v, np.int64) for v in (path, path_at, word, word_at)]
        return x, mask, *ints, count

    def inputs(self, batch):
        x, mask, path, path_at, word, word_at, count = batch
        t, b = mask.shape
        e = np.zeros((t * b, 2 * WIDTH))
        for k in range(WIDTH):
            e[:, k] = np.bincount(path_at, self.p["path"][path, k], t * b)
            e[:, WIDTH + k] = np.bincount(word_at, self.p["word"][word, k], t * b) / count
        return np.concatenate([e.reshape(t, b, -1), x], axis=2)

    @staticmethod
    def run(v, mask, w, bias, back: bool, learn: bool):
        """Hidden states, and (to learn) what the backward pass needs."""
        t, b, _ = v.shape
        h, c = np.zeros((b, HIDDEN)), np.zeros((b, HIDDEN))
        hs, kept = np.zeros((t, b, HIDDEN)), []
        for i in (range(t - 1, -1, -1) if back else range(t)):
            z = np.concatenate([v[i], h], axis=1)
            a = z @ w + bias
            g = np.tanh(a[:, 3 * HIDDEN:])
            s = 1 / (1 + np.exp(-np.clip(a[:, :3 * HIDDEN], -30, 30)))
            ig, fg, og = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            new = fg * c + ig * g
            m = mask[i][:, None]
            if learn:
                kept.append((i, z, ig, fg, og, g, c, np.tanh(new), m))
            h, c = np.where(m, og * np.tanh(new), h), np.where(m, new, c)
            hs[i] = h
        return hs, kept

    @staticmethod
    def back(dhs, kept, w):
        dw, db = np.zeros_like(w), np.zeros(w.shape[1])
        dv = np.zeros((*dhs.shape[:2], w.shape[0] - HIDDEN))
        dh, dc = np.zeros(dhs.shape[1:]), np.zeros(dhs.shape[1:])
        for i, z, ig, fg, og, g, c, tn, m in reversed(kept):
            d = dh + dhs[i]
            own = np.where(m, d, 0)
            dcn = np.where(m, dc, 0) + own * og * (1 - tn ** 2)
            da = np.concatenate([dcn * g * ig * (1 - ig), dcn * c * fg * (1 - fg), own * tn * og * (1 - og),
                                 dcn * ig * (1 - g ** 2)], axis=1)
            dw += z.T @ da
            db += da.sum(axis=0)
            dz = da @ w.T
            dv[i] = dz[:, :-HIDDEN]
            dh = np.where(m, dz[:, -HIDDEN:], d)
            dc = np.where(m, dcn * fg, dc)
        return dv, dw, db

    def logits(self, batch, learn: bool = False):
        v = self.inputs(batch)
        f, kf = self.run(v, batch[1], self.p["wf"], self.p["bf"], False, learn)
        r, kr = self.run(v, batch[1], self.p["wb"], self.p["bb"], True, learn)
        h = np.concatenate([f, r], axis=2)
        return h @ self.p["out"] + self.p["bias"], h, kf, kr

    def gradients(self, batch, y):
        x, mask, path, path_at, word, word_at, count = batch
        logit, h, kf, kr = self.logits(batch, True)
        d = np.where(mask, 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y, 0) / mask.sum()
        g = {"out": np.tensordot(d, h, 2), "bias": np.array([d.sum()])}
        dh = d[..., None] * self.p["out"]
        vf, g["wf"], g["bf"] = self.back(dh[..., :HIDDEN], kf, self.p["wf"])
        vr, g["wb"], g["bb"] = self.back(dh[..., HIDDEN:], kr, self.p["wb"])
        e = (vf + vr)[..., :2 * WIDTH].reshape(-1, 2 * WIDTH)
        g["path"], g["word"] = np.zeros_like(self.p["path"]), np.zeros_like(self.p["word"])
        np.add.at(g["path"], path, e[path_at, :WIDTH])
        np.add.at(g["word"], word, (e[:, WIDTH:] / count[:, None])[word_at])
        return g

    def train(self, pages, labels) -> "Labeller":
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        order, step, rng = np.arange(len(pages)), 0, np.random.default_rng(1)
        for _ in range(EPOCHS):
            rng.shuffle(order)
            for i in range(0, len(order), BATCH):
                pick = order[i:i + BATCH]
                batch = self.batch([pages[j] for j in pick])
                y = np.zeros(batch[1].shape)
                for j, k in enumerate(pick):
                    y[:len(labels[k]), j] = labels[k]
                step += 1
                for k, g in self.gradients(batch, y).items():
                    m, s = state[k]
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    self.p[k] -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-7) + 1e-5 * self.p[k]
        return self

    def texts(self, pages: list[str | None]) -> list[str]:
        out = [""] * len(pages)
        found = [(len(b), i, b) for i, p in enumerate(pages) if p and (b := Blocks(p).out)]
        found.sort(key=lambda x: x[:2])                      # pages of like length together
        a = 0
        while a < len(found):
            b = a + 1
            while b < len(found) and (b + 1 - a) * found[b][0] <= CELLS:
                b += 1
            part, a = found[a:b], b
            yes = self.logits(self.batch([b for _, _, b in part]))[0] > 0
            for j, (n, i, blocks) in enumerate(part):
                out[i] = "\n\n".join(b[0] for b, y in zip(blocks, yes[:n, j]) if y)
        return out


# --- pages to learn from ---------------------------------------------------

#: An element whose name says nothing.
PLAIN = ("div", "?")
NEUTRAL = ["", "row", "col", "grid", "inner", "wrap", "box", "block", "section", "layout", "cell", "left", "center", "panel", "x"]
#: Naming habits by part: (tag, class or id words).
KINDS = {
    "article": [("article", ""), ("main", ""), ("div", "content"), ("div", "article body"), ("div", "post content"), ("section", "entry"),
                ("div", "story"), ("article", "post"), *[PLAIN] * 6],
    "nav": [("nav", ""), ("div", "nav"), ("div", "menu"), ("ul", "navbar"), ("div", "breadcrumbs"), ("nav", "navigation"), ("div", "toc"), PLAIN],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("div", "topbar"), ("div", "banner logo")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("div", "legal"), ("footer", "site")],
    "aside": [("aside", ""), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("div", "widget area"), ("aside", "recommended"), ("div", "share social")],
    "notice": [("div", "cookie notice"), ("div", "consent"), ("div", "popup modal"), ("div", "alert"), ("div", "notice"), ("div", "newsletter subscribe"),
               ("div", "paywall")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "promo"), ("aside", "ad")],
    "form": [("form", ""), ("form", "search"), ("form", "login"), ("form", "subscribe")],
    "comments": [("div", "comments"), ("section", "comments"), ("ol", "comment list"), ("div", "disqus thread"), ("div", "responses"), ("div", "comment")],
}


def training_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page by rule, and for each of its blocks whether it is article text."""
    letters = rng.choice(["etaoinshrdlu", "aeiouñlrsdcm", "enirstüaßhgb", "esaitnruèéoç"])
    parts, labels = [], []

    def words(a, b):
        return " ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(a, b)))

    def sentence(a, b):
        s = words(a, b)
        style = rng.random()
        return s.upper() if style < 0.08 else " | ".join(s.split()) if style < 0.14 else s.capitalize() + rng.choice([".", "", "!", "?"])

    def block(tag, text, good, attributes=""):
        parts.append(f"<{tag}{attributes}>{text}" + (f"</{tag}>" if rng.random() < 0.93 or tag not in ("p", "li") else ""))
        labels.append(int(good))

    def named(kind):
        tag, name = rng.choice(KINDS[kind])
        if not name:
            return tag, ""
        if name == "?":
            name = rng.choice(NEUTRAL)
            return rng.choice(["div", "div", "section", "td"]) if name else "div", name and f' class="{name}-{rng.randint(1, 12)}"'
        joined = rng.choice(["-", "_", " "]).join(name.split())
        if rng.random() < 0.3:
            joined += rng.choice([" wrap", " box", "-1", " clearfix", " main", " col"])
        return tag, f' {rng.choice(["class", "class", "id"])}="{joined}"'

    def links(n):
        for _ in range(n):
            block("li", f'<a href="/x">{words(1, 3)}</a>', False)

    def side(kind):
        tag, attributes = named(kind)
        inner = rng.random()
        parts.append(f"<{tag}{attributes}>")
        if kind == "nav":
            parts.append("<ul>")
            links(rng.randint(1, 9))
            parts.append("</ul>")
        elif kind == "comments":
            for _ in range(rng.randint(1, 5)):
                block(rng.choice(["p", "div", "li"]), sentence(3, 60), False)
        elif kind == "form":
            block("div", f"{words(1, 3)} <input name=q><button>{words(1, 1)}</button>", False)
            if labels and parts[-1].count("<button"):
                labels.append(0)                     # the button's own block
        elif inner < 0.5:
            # bare text directly in the element
            parts.append(sentence(2, 40))
            labels.append(0)
        else:
            if rng.random() < 0.4:
                block(rng.choice(["h2", "h3", "h4"]), words(1, 4), False)
            for _ in range(rng.randint(1, 4)):
                block(rng.choice(["p", "div", "p"]), sentence(2, 50), False)
        parts.append(f"</{tag}>")

    def sides(kinds, most):
        for _ in range(rng.randint(0, most)):
            side(rng.choice(kinds))

    wrapped = rng.random() < 0.3
    nested = rng.random() < 0.3
    parts.append("<html><head><title>x</title></head><body>" + ("<div id=\"page\"><div class=\"container\">" if wrapped else ""))
    sides(["nav", "header", "notice", "advert", "form"], 4)
    tag, attributes = named("article")
    parts.append(f"<{tag}{attributes}>" + (f'<div class="{rng.choice(NEUTRAL)}-{rng.randint(1, 12)}">' if nested else ""))
    if rng.random() < 0.8:
        block(rng.choice(["h1", "h1", "h2"]), sentence(1, 12), True)
    for _ in range(rng.choice([1, 1, 2, 4, 8, 12])):
        r = rng.random()
        if r < 0.72:
            start = rng.choice(["", "", "<b>", "<i>"])
            block(rng.choice(["p"] * 7 + ["div"]), start + sentence(1, rng.choice([4, 15, 90])) + rng.choice(["", "", "<br>"]), True)
        elif r < 0.80:
            block(rng.choice(["h2", "h3"]), words(1, 6), True)
        elif r < 0.86:
            parts.append("<ul>")
            for _ in range(rng.randint(1, 4)):
                block("li", sentence(2, 15), True)
            parts.append("</ul>")
        elif r < 0.9:
            block("blockquote", sentence(4, 30), True)
        elif r < 0.92:
            block("pre", sentence(4, 30), True)
        elif r < 0.94:
            parts.append("<table>")
            for _ in range(rng.randint(1, 5)):
                parts.append("<tr>")
                for _ in range(rng.randint(1, 4)):
                    block(rng.choice(["td", "td", "th"]), words(1, 6), True)
                parts.append("</tr>")
            parts.append("</table>")
        elif r < 0.95:
            parts.append("<figure><img src=x>")
            block("figcaption", sentence(2, 14), True)
            parts.append("</figure>")
        elif r < 0.96:
            parts.append("<dl>")
            for _ in range(rng.randint(1, 4)):
                block("dt", words(1, 4), True)
                block("dd", sentence(2, 20), True)
            parts.append("</dl>")
        elif r < 0.97:
            parts.append(f'<div class="{rng.choice(NEUTRAL)}">')
            for _ in range(rng.randint(1, 3)):
                block("p", sentence(8, 60), True)
            parts.append("</div>")
        else:
            side(rng.choice(["advert", "aside", "notice", "form"]))
    if rng.random() < 0.15:
        side("comments")
    parts.append(("</div>" if nested else "") + f"</{tag}>")
    sides(["aside", "comments", "nav", "advert", "form", "notice"], 4)
    if rng.random() < 0.85:
        side("footer")
    parts.append(("</div></div>" if wrapped else "") + "</body></html>")
    return "".join(parts), labels


_trained: list[Labeller] = []


def trained() -> Labeller:
    """The labeller, trained once in each process that asks for it."""
    if not _trained:
        rng, pages, labels = random.Random(17), [], []
        while len(pages) < PAGES:
            page, y = training_page(rng)
            blocks = Blocks(page).out
            if blocks and len(blocks) == len(y):
                pages.append(blocks)
                labels.append(y)
        _trained.append(Labeller().train(pages, labels))
    return _trained[0]


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the main text of the column ``html``."""
    shared = pages.sparkSession.sparkContext.broadcast(trained())          # fixed size

    @F.arrow_udf("string")
    def text(page: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(page), 512):
            out += shared.value.texts(page.slice(i, 512).to_pylist())
        return pa.array(out, pa.string())

    return drop_clashing(pages, ["text"]).withColumn("text", text(F.coalesce(F.col("html").cast("string"), F.lit(""))))


def query(spark, sf_dir: str) -> DataFrame:
    out = main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
