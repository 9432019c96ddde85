"""SentencePiece BPE by a prefix table: the last token of every prefix, ids recovered backwards."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, map_batches, table, text_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: No piece holds a space mark behind another character, so no merge crosses the start of such a mark.
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: New words after which a worker forgets those it has not met since as many before; this bounds its
#: memory, results do not depend on it.
REMEMBERED = 200_000
#: The score of two neighbours that do not form a piece.
NEVER = float("-inf")


class Codec:
    """Encoder and decoder of one BPE model with byte fallback and no normalisation but the space marks.

    An encoding is the one that merging the best adjacent pair, leftmost first, ends in. Merges
    inside two neighbouring tokens do not depend on the rest of the text, so a token sequence is
    the encoding exactly if every two neighbours encode to themselves. Hence each prefix has one
    last token: the match ending there that is compatible with the last token of what precedes it.
    """

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {i: model.id_to_piece(i) for i in plain}
        self.ids = {piece: i for i, piece in self.pieces.items()}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError(f"{path}: a piece crosses the start of a word")
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = {i: b for b, i in enumerate(self.byte_ids)}
        self.end = model.eos_id()
        self.matches = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matches.add_word(piece, (len(piece), i))
        self.matches.make_automaton()
        self.names = [str(i) for i in range(model.vocab_size())]
        self.surfaces = {i: piece.replace(SPACE, " ") for i, piece in self.pieces.items()} | {self.end: ""}
        #: By last token of what precedes, -1 if it has none: which tokens may follow.
        self.fits: dict[int, dict[int, bool]] = defaultdict(dict)
        self.known: dict[str, tuple[tuple[int, ...], str, str]] = {}
        self.earlier: dict[str, tuple[tuple[int, ...], str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by doing its merges; compatibility tests rest on it."""
        parts, score = list(text), self.scores.get
        # Of each two neighbours; a merge changes only those beside it.
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) != NEVER:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def compatible(self, before: int, token: int) -> bool:
        """Whether the two tokens stay as they are side by side; ``before`` is -1 at a start or after a foreign character."""
        pair = ([self.pieces[before]] if before >= 0 else []) + [self.pieces[token]]
        text = "".join(pair)
        return (before < 0 or text not in self.scores) and self.merged(text) == pair

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text in which spaces are marks already, without a start mark of its own."""
        n, fits = len(chunk), self.fits
        # By prefix length: the last token and its size. A prefix without one, the empty one or one
        # that ends in a character foreign to all pieces, parts the text.
        last, size = [-1] * (n + 1), [1] * (n + 1)
        for at, (length, token) in self.matches.iter(chunk):
            end = at + 1
            if last[end] < 0:
                before = last[end - length]
                after = fits[before]
                fit = after.get(token)
                if fit is None:
                    fit = after[token] = self.compatible(before, token)
                if fit:
                    last[end], size[end] = token, length
        ids: list[int] = []
        while n:
            token = last[n]
            if token < 0:
                ids += [self.byte_ids[b] for b in reversed(chunk[n - 1].encode())]
            else:
                ids.append(token)
            n -= size[n]
        ids.reverse()
        return ids

    def _of(self, chunk: str) -> tuple[tuple[int, ...], str, str]:
        found = self.known.get(chunk) or self.earlier.get(chunk)
        if found is None:
            ids = self.encode_chunk(chunk)
            # Tuples of plain values: the garbage collector does not walk them again and again.
            found = tuple(ids), " ".join([self.names[i] for i in ids]), self._surface(ids)
        if len(chunk) < 64:
            if len(self.known) >= REMEMBERED:
                self.known, self.earlier = {}, self.known
            self.known[chunk] = found
        return found

    def chunks(self, text: str) -> list[tuple[tuple[int, ...], str, str]]:
        """Ids, ids as text and decoded text of each word; none for an empty text."""
        if not text:
            return []
        found = CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return [known or self._of(c) for c, known in zip(found, map(self.known.get, found))]

    def encode(self, text: str) -> list[int]:
        return [i for ids, _, _ in self.chunks(text) for i in ids] + [self.end]

    def _surface(self, ids: list[int]) -> str:
        try:
            return "".join([self.surfaces[i] for i in ids])
        except KeyError:  # bytes among them
            pass
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.bytes:
                run.append(self.bytes[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i in self.pieces:
                out.append(self.surfaces[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: control ids give none, bytes form characters, the added first space goes."""
        return self._surface(ids).removeprefix(" ")


def coded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(id, ids, decoded) of every text; a null one is empty and has the end id alone."""

    def step(batch: pa.RecordBatch, codec: Codec) -> dict:
        ids = [codec.encode(t) for t in batch.column("text").to_pylist()]
        return {"id": batch.column("id"), "ids": ids, "decoded": [codec.decode(i) for i in ids]}

    path = path or public_tokenizers.path(MODEL)
    named = docs.select(id_key().alias("id"), text_of().alias("text"))
    return map_batches(named, "id long, ids array<int>, decoded string", step, lambda: Codec(path), f"codec {path}")


def digested(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): as ``coded``, with digests made where the ids are."""

    def step(batch: pa.RecordBatch, codec: Codec) -> dict:
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch.column("text").to_pylist():
            _, ids, surfaces = zip(*codec.chunks(text), ((), str(codec.end), ""))
            written = " ".join(ids)
            # Every word has ids, and a space stands between any two of them.
            out["n_tokens"].append(written.count(" ") + 1)
            out["ids_sha256"].append(hashlib.sha256(written.encode()).hexdigest())
            # No run of bytes crosses a word, so the words decode one by one.
            decoded = "".join(surfaces).removeprefix(" ")
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
        return out | {"id": batch.column("id")}

    path = path or public_tokenizers.path(MODEL)
    named = docs.select(id_key().alias("id"), text_of().alias("text"))
    return map_batches(named, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", step, lambda: Codec(path), f"codec {path}")


def op9_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every row of ``documents``; a null or empty text is its end id alone.

    Each row is encoded by itself, whatever its id; an empty table gives no rows.
    """
    found = digested(table(spark, sf_dir, "documents"))
    return found.select(id_out("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
