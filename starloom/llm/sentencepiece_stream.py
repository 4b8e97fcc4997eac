"""SentencePiece encoding and decoding (operator 7): streaming Viterbi.

A trellis over the characters of the normalized text has, for each end place,
one best way to reach it: a back pointer to where its last piece starts. Later
pieces can only start at the last ``longest piece`` places, so these are the
surviving paths; as soon as they all go through one boundary, the ids before it
are final, they are committed and their part of the trellis is dropped. Memory
is bounded by the window, not by the text.

What is best depends on the model file:

* unigram models: the sum of the pieces' scores (ties: the longest last piece),
* BPE models: a way is allowed only if every two neighbouring pieces stay as
  they are when the merges run over the two alone. Exactly one way to each
  place is allowed, and it is what the merges make of the text up to there, so
  ids equal the library's for BPE models too.

Some boundaries need no trellis, as no piece spans them: before a run of the
blank mark that follows another character, around characters that no piece
holds, and between any two characters that no piece has side by side. The parts
between them repeat, and a bounded memo keeps their ids. (Models without byte
pieces, where neighbouring unknown characters are one id, are cut before the
blank mark only.)

Edge cases: a null or empty text has no ids; characters without a piece become
byte pieces (or the unknown id, if the model has none); null ids and repeated
rows are kept; an empty table gives no rows. Decoding gives the normalized
text, so a text that holds the blank mark itself comes back with blanks.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import by_bytes, map_arrow, texts

MARK = "▁"
GROUP_BYTES = 1 << 20
LONG_CHARS = 4 << 20
MEMO_PARTS = 350_000
MEMO_PAIRS = 600_000
MEMO_CHARS = 48
#: Places held before the paths are tried for a common boundary.
TRY_PLACES = 256
#: Numbers of no piece: before the text, and of a character that is none.
START, UNKNOWN = (1 << 20) - 1, (1 << 20) - 2
#: Model types of the file format.
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class Memo(dict):
    """Ids of parts, made when they are first asked for. Of two generations the
    older one goes when the younger is full: memory is bounded and frequent
    parts stay."""

    def __init__(self, model: Model):
        self.model = model
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            parts = self.model.split(part)
            ids = b"".join(map(self.__getitem__, parts)) if len(parts) > 1 else array("I", self.model._ids(self.model.trellis(part))).tobytes()
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


class Model:
    """A model's pieces, and its encoder and decoder."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            proto = f.read()
        top = [(k, v) for k, v in _fields(proto) if k in (2, 3)]
        trainer = dict(_fields(next((v for k, v in top if k == 2), b"")))
        normalizer = dict(_fields(next((v for k, v in top if k == 3), b"")))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are read")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.plain = normalizer.get(1, b"") == b"identity" and not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        self.prefix = bool(normalizer.get(3, 1))
        sp = self.library
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        self.unknown = sp.unk_id()
        self.unknown_score = min(self.scores.values()) - 10.0
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(sp.is_byte(i) for i in self.bytes)
        self.longest = max(map(len, self.ids))
        # of each piece and each ending of one: 2 * id + (1 if longer pieces end so), -1 for an ending only
        endings = {p[k:] for p in self.ids for k in range(1, len(p))}
        self.known = dict.fromkeys(endings, -1) | {p: 2 * i + (p in endings) for p, i in self.ids.items()}
        held = set("".join(self.ids))
        alone = "\n" if "\n" not in held and self.fallback else ""
        words = all(MARK not in p.lstrip(MARK) for p in self.ids)
        other = f"[^{MARK}{alone}]"
        self.cut = re.compile(f"{MARK}*{other}+|{MARK}+" + f"|[{alone}]" * bool(alone)) if words else re.compile(r"(?s).+")
        self.text_of = [bytes([self.bytes.index(i)]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        self.is_byte = np.array([sp.is_byte(i) for i in range(size)])
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.pairs: dict[int, bool] = {}
        self.memo = Memo(self)

    def normalize(self, text: str) -> str:
        if not self.plain:
            return self.library.normalize(text)
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def split(self, part: str) -> list[str]:
        """A text cut between characters that no piece has side by side."""
        if not self.fallback:
            return [part]
        inside = self.inside
        cuts = [k for k in range(1, len(part)) if part[k - 1 : k + 1] not in inside]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])]

    def merge(self, text: str) -> list[str]:
        """The pieces that BPE merges make of a short text: again and again the
        neighbours whose union scores best, the leftmost of equals."""
        parts, score, none = list(text), self.scores.get, -math.inf
        gains = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > none:
            i = gains.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            for k in (i - 1, i):
                if 0 <= k < len(gains):
                    gains[k] = score(parts[k] + parts[k + 1], none)
        return parts

    def stays(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay as they are under merges."""
        return self.merge(left + right) == ([left, right] if left else [right])

    def _ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            if p in self.ids:
                out.append(self.ids[p])
            elif self.fallback:
                out += [self.bytes[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:  # neighbouring unknown characters are one
                out.append(self.unknown)
        return out

    def trellis(self, part: str, committed=None) -> list[str]:
        """The best pieces of a text. ``committed`` (for tests) is called with
        each number of places held."""
        known, pairs, longest, bpe = self.known, self.pairs, self.longest, self.kind == BPE
        out: list[str] = []
        base = 0  # place of the latest commit
        # for each place from base on: the start of its path's last piece, that piece's number, the path's score
        start, number, score = [0], [START], [0.0]
        for i in range(1, len(part) + 1):
            if not bpe:
                self._step_unigram(part, i, base, start, number, score)
            else:  # the one allowed way to place i, trying short pieces first
                found, which, j, lowest = i - 1, UNKNOWN, i - 1, max(base, i - longest)
                while j >= lowest:
                    p = part[j:i]
                    info = known.get(p)
                    if info is not None and info >= 0:
                        key = number[j - base] << 20 | info >> 1
                        stays = pairs.get(key)
                        if stays is None:
                            stays = self._stays_at(part, j, i, base, start, out)
                            if number[j - base] != UNKNOWN:
                                if len(pairs) >= MEMO_PAIRS:
                                    pairs.clear()
                                pairs[key] = stays
                        if stays:
                            found, which = j, info >> 1
                            break
                        if not info & 1:
                            break
                    elif info is None or j == i - 1 and self._stays_at(part, j, i, base, start, out):
                        break  # no longer piece ends so, or a character that is no piece
                    j -= 1
                start.append(found)
                number.append(which)
            if len(start) > TRY_PLACES and not len(start) % 64:
                # boundaries that all surviving paths share
                common: set[int] | None = None
                for end in range(max(i - self.longest, base), i + 1):
                    path = {end}
                    while end > base:
                        end = start[end - base]
                        path.add(end)
                    common = path if common is None else common & path
                boundary = max(common)
                if boundary > base:
                    out += self._path(part, start, base, boundary)
                    start, number, score = (x[boundary - base :] for x in (start, number, score))
                    base = boundary
                if committed:
                    committed(len(start))
        return out + self._path(part, start, base, len(part))

    def _stays_at(self, part: str, j: int, i: int, base: int, start: list, out: list) -> bool:
        before = part[start[j - base] : j] if j > base else out[-1] if out else ""
        return self.stays(before, part[j:i])

    def _step_unigram(self, part: str, i: int, base: int, start: list, number: list, score: list) -> None:
        """Find the best-scored way to place i; of equals the longest piece."""
        known, scores = self.known, self.scores
        found, best = i - 1, score[i - 1 - base] + scores.get(part[i - 1], self.unknown_score)
        info, j = known.get(part[i - 1]), i - 2
        while j >= max(base, i - self.longest) and info is not None and info & 1:
            p = part[j:i]
            info = known.get(p)
            if info is not None and info >= 0 and (total := score[j - base] + scores[p]) >= best:
                found, best = j, total
            j -= 1
        start.append(found)
        number.append(UNKNOWN)
        score.append(best)

    @staticmethod
    def _path(part: str, start: list[int], base: int, end: int) -> list[str]:
        out = []
        while end > base:
            out.append(part[start[end - base] : end])
            end = start[end - base]
        return out[::-1]

    def encode(self, group: list[str]) -> list[bytes]:
        """Ids of some texts, each as little-endian 32-bit numbers."""
        ids = self.memo.__getitem__
        # the parts of a long text are not held all at once
        parts = lambda t: self.cut.findall(t) if len(t) <= LONG_CHARS else (m[0] for m in self.cut.finditer(t))
        return [b"".join(map(ids, parts(self.normalize(t)))) for t in group]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.text_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """A model, read once for each Python worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, n_byte_tokens, ids) of each row; ids: binary,
    little-endian unsigned 32-bit. ``keep``: columns of ``texts`` to keep."""

    def run(batches):
        m = model(model_path)
        for batch in batches:
            for a, b in by_bytes(batch.column("text"), GROUP_BYTES):
                part = batch.slice(a, b - a)
                ids = m.encode(part.column("text").to_pylist())
                out = {c: part.column(c) for c in ("doc_id", *keep)}
                out["n_tokens"] = pa.array([len(x) // 4 for x in ids], pa.int64())
                out["n_byte_tokens"] = pa.array([int(m.is_byte[np.frombuffer(x, "<u4")].sum()) for x in ids], pa.int64())
                yield pa.RecordBatch.from_pydict(out | {"ids": pa.array(ids, pa.binary())})

    rows = texts(df, id_col, text_col)
    kinds = dict(rows.dtypes)
    return map_arrow(rows, run, ", ".join(["doc_id long", *(f"{c} {kinds[c]}" for c in keep), "n_tokens long", "n_byte_tokens long", "ids binary"]))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with the text that its ids stand for, as ``decoded``; a null
    is no ids."""

    def run(batches):
        m = model(model_path)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                decoded = [m.decode(np.frombuffer(x or b"", "<u4")) for x in part.column("ids").to_pylist()]
                columns = {c: part.column(c) for c in part.schema.names}
                yield pa.RecordBatch.from_pydict(columns | {"decoded": pa.array(decoded, pa.string())})

    rows = encoded.drop("decoded")
    return map_arrow(rows, run, ", ".join([f"`{c}` {k}" for c, k in rows.dtypes] + ["decoded string"]))


def round_trip(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_byte_tokens, ids_crc32, same): encode,
    decode, and compare with the text; the ids too if asked for. Both ways run
    in one Python worker, so only the digest leaves it."""

    def run(batches):
        m = model(model_path)
        for batch in batches:
            for a, b in by_bytes(batch.column("text"), GROUP_BYTES):
                part = batch.slice(a, b - a)
                group = part.column("text").to_pylist()
                blobs = m.encode(group)
                ids = [np.frombuffer(x, "<u4") for x in blobs]
                out = {"doc_id": part.column("doc_id"), "n_bytes": part.column("n_bytes")}
                out |= {"n_tokens": pa.array([len(x) for x in ids], pa.int64()), "n_byte_tokens": pa.array([int(m.is_byte[x].sum()) for x in ids], pa.int64())}
                out |= {"ids_crc32": pa.array(map(zlib.crc32, blobs), pa.int64()), "same": pa.array([m.decode(x) == t for x, t in zip(ids, group, strict=True)])}
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(blobs, pa.binary())} if with_ids else {}))

    rows = texts(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_arrow(rows, run, "doc_id long, n_bytes long, n_tokens long, n_byte_tokens long, ids_crc32 long, same boolean" + ", ids binary" * with_ids)
