"""Ids of whole texts by a tokenizers file, with the library asked once for each new segment of text."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Two characters that Python's ``\\s`` matches, for Arrow's regular expressions.
_TWO_BLANKS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
#: Marks that end a word; a letter and one of these are never one piece.
_MARKS = pa.array(list(".,;:!?"), pa.large_string())
_MARKED = "[A-Za-z][.,;:!?]$"


class SegmentEncoder:
    """Ids as little-endian unsigned 32-bit bytes.

    ``blanks_kept`` is for byte-level tokenizers, whose pieces take a blank
    only at their start: where no two blanks meet, a text is cut before each
    space and line feed.  Otherwise the tokenizer drops blanks and a text is
    cut at them.  Either way no piece reaches across a cut.  Other texts, and
    those that hold the string of an added token, go to the library whole.
    Of earlier segments the last used are kept, bounded in entries and length,
    as one Arrow array of segments and one numpy array of all their ids.
    """

    def __init__(self, path: str, blanks_kept: bool, entries: int = 500_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        self._added = [t.content for t in added.values()]
        self._between_id, self._between = next((i, t.content) for i, t in added.items() if not (t.lstrip or t.rstrip or t.normalized))
        self._blanks_kept, self._entries, self._longest = blanks_kept, entries, longest
        self._keys = pa.array([], pa.large_string())
        self._starts, self._sizes, self._used = (np.zeros(0, kind) for kind in (np.int64, np.int32, np.int32))
        self._ids, self._turn = np.zeros(0, "<u4"), 0
        marks = self._ask(_MARKS.to_pylist())
        self._mark_ids = np.frombuffer(b"".join(marks), "<u4")
        if len(self._mark_ids) != len(marks):
            raise ValueError("a mark is more than one piece")

    def _ask(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that hold no added token, put to the library as one text with an added token between each two."""
        out: list[bytes] = []
        for start in range(0, len(texts), 4096):
            own = texts[start:start + 4096]
            ids = np.array(self._tokenizer.encode_batch_fast([self._between.join(own)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self._between_id)
            if len(cuts) != len(own) - 1:
                raise ValueError("the added token did not keep the texts apart")
            coded, cuts = ids.tobytes(), (4 * cuts).tolist()
            out += [coded[a:b] for a, b in zip([0] + [c + 4 for c in cuts], cuts + [len(coded)])]
        return out

    def _ask_whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(coded.ids, "<u4").tobytes() for coded in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, key: str) -> str:
        """The segment that a key stands for."""
        if not self._blanks_kept or key[:1] == "\n":
            return key
        return key[1:] if key[:1] == " " else " " + key

    def _look_up(self, keys: pa.Array) -> np.ndarray:
        """Where the ids of distinct keys are kept; new ones are asked for."""
        at = pc.fill_null(pc.index_in(keys, value_set=self._keys), -1).to_numpy().copy()
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = keys.take(pa.array(new))
            coded = self._ask([self._plain(k) for k in fresh.to_pylist()])
            sizes = np.fromiter(map(len, coded), np.int32, len(coded)) // 4
            at[new] = len(self._keys) + np.arange(len(new))
            self._keys = pa.concat_arrays([self._keys, fresh])
            self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(sizes, dtype=np.int64) - sizes])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._used = np.concatenate([self._used, np.zeros(len(new), np.int32)])
            self._ids = np.concatenate([self._ids, np.frombuffer(b"".join(coded), "<u4")])
        self._turn += 1
        self._used[at] = self._turn
        return at

    def _forget(self) -> None:
        """Drop long segments and, beyond the bound, the half not used for longest."""
        kept = pc.binary_length(self._keys).to_numpy() <= self._longest
        if len(kept) > self._entries:
            latest = np.argsort(-self._used, kind="stable")[: self._entries // 2]
            recent = np.zeros(len(kept), bool)
            recent[latest] = True
            kept &= recent
        if kept.all():
            return
        at = np.flatnonzero(kept)
        starts, sizes = self._starts[at], self._sizes[at]
        ends = np.cumsum(sizes, dtype=np.int64)
        self._ids = self._ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]
        self._keys, self._starts, self._sizes, self._used = self._keys.take(pa.array(at)), ends - sizes, sizes, self._used[at]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Segments are told apart and laid out again in Arrow and numpy; only distinct ones are looked up."""
        if not texts:
            return []
        given = pa.array([t or "" for t in texts], pa.large_string())
        apart = np.array([any(a in t for a in self._added) if t else False for t in texts], bool)  # to be encoded whole
        if self._blanks_kept:
            apart |= pc.match_substring_regex(given, _TWO_BLANKS).to_numpy(zero_copy_only=False)
        given = pc.if_else(pa.array(apart), "", given)
        lists = pc.split_pattern(pc.replace_substring(given, "\n", " \n" if self._blanks_kept else " "), " ")
        first = lists.offsets.to_numpy().astype(np.int64)
        values = lists.flatten().dictionary_encode()
        index, keys = values.indices.to_numpy().copy(), values.dictionary
        if self._blanks_kept:  # no blank stands before the first word of a text: a space marks that
            empty, space = (pa.scalar(t, pa.large_string()) for t in ("", " "))
            heads = pc.binary_join_element_wise(space, keys.take(pa.array(index[first[:-1]])), empty)
            index[first[:-1]] = len(keys) + np.arange(len(texts))
            keys = pa.concat_arrays([keys, heads])
        # A mark after a letter is a piece of its own, so a word is kept once, whatever mark follows.
        marked = pc.match_substring_regex(keys, _MARKED)
        mark = pc.fill_null(pc.index_in(pc.utf8_slice_codeunits(keys, -1), value_set=_MARKS), 0).to_numpy()
        words = pc.if_else(marked, pc.utf8_slice_codeunits(keys, 0, -1), keys).dictionary_encode()
        marked = marked.to_numpy(zero_copy_only=False)
        at = self._look_up(words.dictionary)[words.indices.to_numpy()]
        starts, sizes = self._starts[at], self._sizes[at]
        body, ending = sizes[index], marked[index]
        body[first[:-1][apart]], ending[first[:-1][apart]] = 0, False
        ends = np.cumsum(body + ending, dtype=np.int64)
        ids = np.empty(ends[-1], "<u4")
        own, marks_at = np.ones(len(ids), bool), ends[ending] - 1
        own[marks_at] = False
        done = np.cumsum(body, dtype=np.int64)
        ids[own] = self._ids[np.arange(done[-1]) + np.repeat(starts[index] - done + body, body)]
        ids[marks_at] = self._mark_ids[mark[index[ending]]]
        self._forget()
        ids = ids.tobytes()
        bounds = (4 * np.concatenate([[0], ends])[first]).tolist()
        others = iter(self._ask_whole([t for t, w in zip(texts, apart) if w]))
        return [next(others) if w else ids[a:b] for w, a, b in zip(apart, bounds, bounds[1:])]


@lru_cache(maxsize=2)
def encoder(path: str, blanks_kept: bool) -> SegmentEncoder:
    return SegmentEncoder(path, blanks_kept)
