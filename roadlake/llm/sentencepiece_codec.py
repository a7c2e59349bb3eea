"""SentencePiece (BPE) encoding and decoding by a prefix table.

Merging pairs by score gives every prefix of a text one last token. The
tokens that end at a place are found by an Aho-Corasick automaton over the
pieces; the right one is that which is compatible with the last token of the
prefix before it, that is, the two side by side stay two under merging. The
table of last tokens is filled from left to right and read backwards for the
ids.

Spaces become U+2581 and one is put in front, as the model's normaliser says
(identity otherwise; other models are refused). No piece holds U+2581 after
another character, and no piece a line feed, so texts split there exactly;
the tokens of such chunks are remembered up to a fixed number of chunks.
Characters outside the vocabulary become byte tokens.

The model's pieces (a bounded list) are read on the driver from a path that
is a parameter, and sent to the tasks.

Defined cases: a null text is empty; an empty text has no ids and decodes to
the empty text; unknown ids raise; equal texts get equal ids; other columns
pass through, clashing result columns are replaced.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import drop_clashing, read, text_of

MARK = "▁"
REMEMBERED = 700_000


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(model_file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kind = lambda i: ("byte" if sp.is_byte(i) else "control" if sp.is_control(i) else
                      "unknown" if sp.is_unknown(i) else "unused" if sp.is_unused(i) else "normal")
    pieces = [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]
    probe = "a  ﬁ　é "
    if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError("the model's normaliser is not the identity with a space in front")
    if sum(k == "byte" for _, _, k in pieces) != 256 or any(k == "unused" for _, _, k in pieces):
        raise ValueError("the model has no byte tokens, or unused pieces")
    if any(MARK in p.lstrip(MARK) or "\n" in p for p, _, k in pieces if k == "normal"):
        raise ValueError("a piece spans words or lines")
    return pieces


class Memo(dict):
    """Results by argument; emptied when full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class Codec:
    def __init__(self, pieces: list[tuple[str, float, str]]):
        import ahocorasick

        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == "normal"}
        self.scores = {p: s for p, s, k in pieces if k == "normal"}
        self.pieces = [p for p, _, _ in pieces]
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            # a piece that merging does not build is never a token
            if len(p) == 1 or self.merged(p) == [p]:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.size = len(pieces)
        self.compatible = Memo(self.stay_two, 600_000)
        self.chunk_ids = Memo(self.encode_chunk, REMEMBERED)
        self.chunks = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall
        self.raw = [bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "control" else " ⁇ ".encode()
                    if k == "unknown" else p.replace(MARK, " ").encode() for p, _, k in pieces]
        self.marked = [k == "normal" and p.startswith(MARK) for p, _, k in pieces]
        self.is_byte = [k == "byte" for _, _, k in pieces]
        self.is_control = [k == "control" for _, _, k in pieces]
        self.text_of_id = [str(i) for i in range(len(pieces))]

    def stay_two(self, pair: int) -> bool:
        """Whether merging leaves the two tokens (first * size + second) apart."""
        a, b = (self.pieces[i] for i in divmod(pair, self.size))
        return self.merged(a + b) == [a, b]

    def merged(self, s: str) -> list[str]:
        """Tokens of a short string by merging the best pair until none is left."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def last_tokens(self, s: str) -> list[int]:
        """Id of the last token of every prefix of ``s``; -1: an unknown
        character, which takes part in no merge."""
        last = [-1] * (len(s) + 1)
        compatible, size = self.compatible, self.size
        for end, (i, n) in self.automaton.iter(s):      # longest first at each end
            end += 1
            if last[end] < 0:
                before = last[end - n]
                if before < 0 or compatible[before * size + i]:
                    last[end] = i
        return last

    def encode_chunk(self, s: str) -> tuple[int, ...]:
        last, end, out = self.last_tokens(s), len(s), []
        while end:
            i = last[end]
            if i >= 0:
                out.append(i)
                end -= len(self.pieces[i])
            else:
                out += [self.byte_id[b] for b in reversed(s[end - 1].encode())]
                end -= 1
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.chunk_ids.__getitem__, self.chunks(MARK + text.replace(" ", MARK)))))

    def decode(self, ids) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if not self.is_control[i]), None)
        skip = first is not None and self.marked[first]
        try:
            return raw[skip:].decode()
        except UnicodeDecodeError:
            return self.decode_broken(ids)[skip:]

    def decode_broken(self, ids) -> str:
        """Every byte of a run of byte tokens that is part of no valid
        character becomes U+FFFD."""
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.raw[i]
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            if i is not None:
                out.append(self.raw[i].decode())
        return "".join(out)


_codecs: dict[str, Codec] = {}


def codec(key: str, pieces) -> Codec:
    """One codec in each Python worker, with what it has remembered."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(pieces)
    return _codecs[key]


def _shared(df: DataFrame, model_file: str):
    pieces = load_pieces(model_file)
    key = hashlib.sha256(repr(pieces).encode()).hexdigest()
    return key, df.sparkSession.sparkContext.broadcast(pieces)


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ``ids``, an array of the text's token ids."""
    key, pieces = _shared(docs, model_file)

    @F.arrow_udf("array<int>")
    def ids(text: pa.Array) -> pa.Array:
        c = codec(key, pieces.value)
        return pa.array([c.encode(t) for t in text.to_pylist()], pa.list_(pa.int32()))

    return drop_clashing(docs, ["ids"]).withColumn("ids", ids(text_of()))


def decode(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ``decoded``, the text of the column ``ids`` (null: none)."""
    key, pieces = _shared(docs, model_file)

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        c = codec(key, pieces.value)
        return pa.array([None if x is None else c.decode(x) for x in ids.to_pylist()], pa.string())

    return drop_clashing(docs, ["decoded"]).withColumn("decoded", text(F.col("ids")))


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256: encodes and
    decodes every text in one pass, without sending the ids back."""
    key, pieces = _shared(docs, model_file)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def both(text: pa.Array) -> pa.Array:
        c = codec(key, pieces.value)
        n, a, b = [], [], []
        for t in text:
            ids = c.encode(t.as_py())
            n.append(len(ids))
            a.append(hashlib.sha256(",".join(map(c.text_of_id.__getitem__, ids)).encode()).hexdigest())
            b.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                          names=["n_tokens", "ids_sha256", "decoded_sha256"])

    docs = drop_clashing(docs, ["n_tokens", "ids_sha256", "decoded_sha256", "llm_digest"])
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn("llm_digest", both(text_of())).select(*own, "llm_digest.*")


def query(spark, sf_dir: str, model_file: str | None = None) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, model_file or default_model()).drop("text")
