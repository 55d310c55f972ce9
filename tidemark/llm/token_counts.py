"""Token counts by a compiled counting transducer (operator 10).

A sentencepiece BPE model whose pieces never reach over a word border is a finite-state machine over
*lexemes*: a run of blanks with the word after it, or one line break. The machine has two states, START
(the implied leading blank is still due) and MID; reading a lexeme in a state emits a fixed number of tokens.
`CountTransducer` compiles these transitions from the model on first use, as a lazy automaton does, and keeps
them in a table of bounded size, in which frequent lexemes stay.

Long texts are cut into chunks of code points anywhere. A chunk's *state map* is what it does for any state it
may be entered in: the part before its first sure border (`head`), the tokens emitted between its first and
last border (`count`), and the open part after it (`tail`). Maps compose associatively, so Spark folds them by
blocks of chunks and then by text: a parallel prefix scan in two levels. One text never needs one task.

Borders are proven from the model's vocabulary and normaliser when it is loaded; for a model without them
every text is a single lexeme, which is slower and still exact.

Cases: null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated results; an empty table gives
an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, emit, groups, text_of

CHUNK_CHARS = 65_536     # code points per chunk
BLOCK_CHUNKS = 64        # chunks whose maps one task folds in the first level
TABLE_SIZE = 200_000     # transitions of one generation of the table, per Python worker

BLANK = "▁"


class CountTransducer:
    """START and MID transitions over lexemes, each with its count of emitted tokens."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(model_path, "rb") as f:
            data = f.read()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        spec = proto.ModelProto()
        spec.ParseFromString(data)
        kinds = proto.ModelProto.SentencePiece
        plain = [p.piece for p in spec.pieces if p.type == kinds.NORMAL]
        norm = spec.normalizer_spec
        self.lexical = (
            not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces
            and not any(p.type == kinds.USER_DEFINED for p in spec.pieces)
            and not any(BLANK in p.lstrip(BLANK) or "\n" in p or " " in p for p in plain))
        self.lexemes = re.compile(f"[ {BLANK}]*[^ {BLANK}\n]+|[ {BLANK}]+|\n" if self.lexical else r"(?s).+").findall
        # a border stands before a line break, after one, and before a blank that follows a non-blank
        self.border = re.compile(f"(?<=[^ {BLANK}])(?=[ {BLANK}])|(?<=\n)|(?<!^)(?=\n)").search if self.lexical else None
        self.newline = len(self.sp.encode("\n"))
        self.table = Memo(self.mid, TABLE_SIZE)

    def mid(self, lexeme: str) -> int:
        """Tokens emitted for a lexeme read in state MID: behind a border there is no implied blank."""
        return len(self.sp.encode("\n" + lexeme)) - self.newline

    def count(self, text: str, start: bool) -> int:
        """Tokens of a text that begins and ends at borders."""
        if not text:
            return 0
        if not self.lexical:
            return len(self.sp.encode(text)) if start else self.mid(text)
        if not start:
            return sum(map(self.table.__getitem__, self.lexemes(text)))
        found = self.lexemes(text)
        first = found[0]
        return len(self.sp.encode(first)) + sum(map(self.table.__getitem__, found[1:]))

    def map_of(self, chunk: str) -> tuple[str, bool, int, str]:
        """(head, has a border, tokens between the first and the last border, tail)."""
        at = self.border(chunk) if self.border else None
        if not at or at.end() >= len(chunk):
            return chunk, False, 0, ""
        p = at.end()
        rest = self.lexemes(chunk[p:])
        tail = "" if rest[-1] == "\n" else rest.pop()
        return chunk[:p], True, sum(map(self.table.__getitem__, rest)), tail

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of a followed by b."""
        (ah, ab, ac, at), (bh, bb, bc, bt) = a, b
        if ab and bb:
            return ah, True, ac + self.count(at + bh, False) + bc, bt
        if ab:
            h, border, c, t = self.map_of(at + bh) if at + bh else ("", False, 0, "")
            return (ah, True, ac + self.count(h, False) + c, t) if border else (ah, True, ac, h)
        h, border, c, t = self.map_of(ah + bh)
        if bb:
            return (h, True, c + self.count(t, False) + bc, bt) if border else (h, True, bc, bt)
        return h, border, c, t

    def total(self, m: tuple) -> int:
        """Tokens of a whole text with this map."""
        return self.count(m[0], True) + m[2] + self.count(m[3], False)


_LOADED: dict[str, CountTransducer] = {}


def transducer(model_path: str) -> CountTransducer:
    """Once per Python worker."""
    if model_path not in _LOADED:
        _LOADED[model_path] = CountTransducer(model_path)
    return _LOADED[model_path]


_MAPS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chunks", pa.int32()),
                   ("chunk_no", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("head", pa.string()),
                   ("has_border", pa.bool_()), ("inner", pa.int64()), ("tail", pa.string())])
_MAPS_DDL = ("uid long, doc_id long, n_bytes long, n_chunks int, chunk_no int, block int, n_tokens long, "
             "head string, has_border boolean, inner long, tail string")


def count_tokens(docs: DataFrame, model_path: str, max_tokens: int = 4096,
                 chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_chunks: one row per input row, over whole texts."""
    text = text_of()
    # one pass over the text: a substring of each chunk would walk to its place from the start every time. The possessive
    # quantifier neither backtracks nor recurses
    cut = F.when(F.char_length("t") <= chunk_chars, F.array("t")).otherwise(
        F.regexp_extract_all("t", F.lit(f"(?s).{{1,{chunk_chars}}}+"), F.lit(0)))
    chunks = (docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), text.alias("t"))
              .select("uid", "doc_id", F.octet_length("t").cast("long").alias("n_bytes"), cut.alias("parts"))
              .select("uid", "doc_id", "n_bytes", F.size("parts").alias("n_chunks"), F.posexplode("parts"))
              .withColumnsRenamed({"pos": "chunk_no", "col": "chunk"}))

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tr = transducer(model_path)
        for b in batches:
            uid, doc, size, n, no, chunk = (b.column(c).to_pylist() for c in
                                            ("uid", "doc_id", "n_bytes", "n_chunks", "chunk_no", "chunk"))
            whole = [tr.count(c, True) if k == 1 else None for c, k in zip(chunk, n)]
            parts = [tr.map_of(c) if k > 1 else (None, None, None, None) for c, k in zip(chunk, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(
                    (uid, doc, size, n, no, [i // BLOCK_CHUNKS for i in no], whole, *zip(*parts)), _MAPS)] if uid
                else [pa.array([], f.type) for f in _MAPS], schema=_MAPS)

    def fold(keys: list[str], last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tr = transducer(model_path)

            def rows():
                for _, part in groups(batches, keys):
                    first = part[0]
                    if first["n_chunks"] > 1:
                        m = None
                        for r in part:
                            own = (r["head"], r["has_border"], r["inner"], r["tail"])
                            m = own if m is None else tr.compose(m, own)
                        first = first | dict(zip(("head", "has_border", "inner", "tail"), m))
                        if last:
                            first |= {"n_tokens": tr.total(m), "head": None, "tail": None}
                    yield first
            yield from emit(rows(), _MAPS)
        return run

    level0 = chunks.mapInArrow(maps, _MAPS_DDL)
    level1 = (level0.repartition("uid", "block").sortWithinPartitions("uid", "block", "chunk_no")
              .mapInArrow(fold(["uid", "block"], False), _MAPS_DDL))
    level2 = (level1.repartition("uid").sortWithinPartitions("uid", "chunk_no")
              .mapInArrow(fold(["uid"], True), _MAPS_DDL))
    return level2.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"), "n_chunks")
