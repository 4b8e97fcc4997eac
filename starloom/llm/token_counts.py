"""Token counts (operator 2): lengths only, in Arrow batches.

Texts are taken in groups of about ``GROUP_BYTES``, whatever the number of
rows, and split at safe boundaries: blanks and line feeds. The tokenizer's
pre-tokenizer drops white space and no token spans it, so the length of a text
is the sum of the lengths of its parts. The parts of a group that a bounded memo
in the Python worker does not have are encoded together, in batches of about
``BATCH_BYTES``. No ids leave the task.

Only tokenizers that drop white space may be counted by parts (their file says so,
``drops_white_space``); for others ``token_counts`` takes ``split=False`` and encodes
whole texts, and refuses ``split=True``.

Edge cases: a null or empty text has 0 tokens; null or repeated ids are kept
row by row; an empty table gives no rows; other columns are pruned, so their names
cannot clash.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import by_bytes, map_arrow, texts

GROUP_BYTES = 1 << 20
BATCH_BYTES = 256 << 10
LONG_CHARS = 4 << 20
MEMO_PARTS = 400_000
MEMO_CHARS = 48

#: Latin letters with marks (no apostrophe) after them: another safe boundary,
#: where the pre-tokenizer tells letters from other characters. (In lower case one
#: letter, U+0130, has a mark of its own, so it is left out.)
MARKED = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\\[-`{-~]+)")


class Lengths:
    """Token counts of parts. Of two generations of the memo the older one goes
    when the younger is full: memory is bounded and frequent parts stay."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        """Lengths of some texts, encoded in batches of about ``BATCH_BYTES``."""
        out: list[int] = []
        for a, b in by_bytes(pa.array(texts, pa.large_string()), BATCH_BYTES):
            out.extend(len(e.ids) for e in self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False))
        return out

    def of(self, parted: list[list[str]]) -> list[int]:
        """Lengths of texts given by their parts."""
        needed = set().union(*parted)
        if len(self.memo) + len(needed) > MEMO_PARTS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        marked, new = {}, set()
        for p in needed.difference(memo):
            if p in older:
                memo[p] = older[p]
            elif two := MARKED.fullmatch(p):
                marked[p] = two.groups()
                new.update(marked[p])
            else:
                new.add(p)
        for p in new & older.keys():
            memo[p] = older[p]
        unknown = list(new - memo.keys())
        memo.update(zip(unknown, self.whole(unknown), strict=True))
        for p, (letters, marks) in marked.items():
            memo[p] = memo[letters] + memo[marks]
        out = [sum(map(memo.__getitem__, parts)) for parts in parted]
        for p in needed | new:
            if len(p) > MEMO_CHARS:
                del memo[p]
        return out


_loaded: dict[str, Lengths] = {}


def count_group(path: str, group: list[str], split: bool = True) -> list[int]:
    """Token counts of some texts; the memo lives as long as the Python worker."""
    if path not in _loaded:
        _loaded[path] = Lengths(path)
    if not split:
        return _loaded[path].whole(group)
    count = lambda texts: _loaded[path].of([t.replace("\n", " ").split(" ") for t in texts])
    if max(map(len, group), default=0) <= LONG_CHARS:
        return count(group)
    # a long text's parts are not held all at once
    return [sum(sum(count([piece])) for piece in pieces(t)) for t in group]


def pieces(text: str):
    """A text in pieces of about ``LONG_CHARS`` that end before a blank."""
    start = 0
    while start < len(text):
        end = text.find(" ", start + LONG_CHARS)
        end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


def drops_white_space(path: str) -> bool:
    """Whether a tokenizer's first pre-tokenizer removes white space, so no token holds
    or spans it, by its JSON file."""
    with open(path, encoding="utf-8") as f:
        first = json.load(f).get("pre_tokenizer") or {}
    while first.get("type") == "Sequence" and first["pretokenizers"]:
        first = first["pretokenizers"][0]
    if first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return True
    pattern = first.get("pattern", {}).get("Regex", "")
    # only what the pattern matches stays, and none of its characters or classes is white space
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert", False) and not re.search(r" |\\s(?![^\[]*\])|\[\^(?![^\]]*\\s)", pattern)


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", split: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``df``."""
    if split and not drops_white_space(tokenizer_path):
        raise ValueError(f"{tokenizer_path} keeps white space, so its texts cannot be counted by parts: use split=False")

    def count(batches):
        for batch in batches:
            column, counts = batch.column("text"), []
            for a, b in by_bytes(column, GROUP_BYTES):
                counts += count_group(tokenizer_path, column.slice(a, b - a).to_pylist(), split)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = texts(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_arrow(rows, count, "doc_id long, n_bytes long, n_tokens long")
