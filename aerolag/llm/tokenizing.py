"""Token ids of whole texts by a public tokenizer, faster through a store of words already seen.

Both vocabularies cut a text into words before they merge anything, and never across the places where
it is cut here, so the ids of the parts are the ids of the text.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from aerolag.llm import caches

#: Words kept in each of two generations; when the newer is full it becomes the older.
WORDS_KEPT = 400_000
END_ID = 0
#: The tokenizers' special token, which parts words that are encoded together.
SPECIAL = "<|endoftext|>"
#: Words of letters and other words that are encoded as one text, and so many words in a call.
LETTERS_AT_ONCE, WORDS_AT_ONCE = 256, 64
WORDS_A_CALL = 1 << 14

#: Blanks that do not stand alone, and white space other than blanks and line breaks.
_ODD_BLANKS = (
    r"^[ \n]|  |\n\n|\n | \n|[\t\r\x{0b}\x{0c}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

#: Words of letters every Unicode version has, and whose lower case is one letter.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


class Encoder:
    """Ids by ``add_special_tokens=False`` of the tokenizer file at ``path``.

    ``blank_joins``: a blank belongs to the word after it (byte-level vocabularies); else white space
    only parts words.
    """

    def __init__(self, path: str, blank_joins: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = self.tokenizer.token_to_id(SPECIAL)
        self.blank_joins = blank_joins
        vocabulary = self.tokenizer.get_vocab()
        self.type = np.dtype("<u2") if max(vocabulary.values()) < 1 << 16 else np.dtype("<u4")
        # Ids that begin a word after a blank, or end a word.
        self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.edge[number] = token.startswith("\u0120") if blank_joins else token.endswith("</w>")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _parts(self, texts: pa.Array) -> pa.ListArray:
        """The words of texts whose blanks stand alone.

        With joined blanks, a part that starts with a line break stands for itself, any other for a
        blank and itself; every text gets a line break before it.
        """
        if not self.blank_joins:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        return pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, dtype=self.type) for encoding in encodings]

    def _cut(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data, size = ids.tobytes(), self.type.itemsize
        return [data[a * size : b * size] for a, b in zip(starts.tolist(), ends.tolist())]

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each part on its own, many at a time: words of letters by their edges, others by the special token."""
        found: dict[str, bytes] = {}
        letters = list(filter(_LETTERS.fullmatch, parts))
        for start in range(0, len(letters), WORDS_A_CALL):
            some = letters[start : start + WORDS_A_CALL]
            groups = [some[i : i + LETTERS_AT_ONCE] for i in range(0, len(some), LETTERS_AT_ONCE)]
            lead = " " if self.blank_joins else ""
            for group, ids in zip(groups, self._ids([lead + " ".join(group) for group in groups])):
                edges = np.flatnonzero(self.edge[ids])
                if len(edges) != len(group):
                    found.update((part, self._whole(lead + part)) for part in group)
                elif self.blank_joins:
                    found.update(zip(group, self._cut(ids, edges, np.append(edges[1:], len(ids)))))
                else:
                    found.update(zip(group, self._cut(ids, np.append(0, edges[:-1] + 1), edges + 1)))
        rest = [part for part in parts if part not in found]
        texts = [part if part[:1] == "\n" or not self.blank_joins else " " + part for part in rest]
        plain = [i for i, text in enumerate(texts) if "<|" not in text]
        for start in range(0, len(plain), WORDS_A_CALL):
            some = plain[start : start + WORDS_A_CALL]
            groups = [some[i : i + WORDS_AT_ONCE] for i in range(0, len(some), WORDS_AT_ONCE)]
            for group, ids in zip(groups, self._ids([SPECIAL.join([texts[i] for i in group]) for group in groups])):
                cuts = np.flatnonzero(ids == self.special)
                found.update(zip([rest[i] for i in group], self._cut(ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))))
        found.update((rest[i], self._whole(text)) for i, text in enumerate(texts) if "<|" in text)
        return [found[part] for part in parts]

    def _whole(self, text: str) -> bytes:
        return self._ids([text])[0].tobytes()

    def _learn(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct ``parts``, which are in the newer generation then."""
        if len(self.new) > WORDS_KEPT:
            self.old, self.new = self.new, {}
        new = self.new
        known = list(map(new.get, parts))
        places = [place for place, ids in enumerate(known) if ids is None]
        missing = [parts[place] for place in places]
        unknown: dict[str, None] = {}
        ends = []
        for part, ids in zip(missing, list(map(self.old.get, missing))):
            if ids is not None:
                new[part] = ids
            elif part[-1:] in (",", ".") and _LETTERS.fullmatch(part, 0, len(part) - 1):
                # The tokenizers part letters from what follows them.
                ends.append(part)
                if part[:-1] not in new:
                    unknown[part[:-1]] = None
            else:
                unknown[part] = None
        new.update(zip(unknown, self._encode(list(unknown))))
        for part in ends:
            if part[-1] not in self.marks:
                self.marks[part[-1]] = self._whole(part[-1])
            new[part] = new[part[:-1]] + self.marks[part[-1]]
        for place, part in zip(places, missing):
            known[place] = new[part]
        return known

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text and the end id; a null text has the end id alone."""
        end = np.array([END_ID], dtype=self.type)
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD_BLANKS).to_numpy(zero_copy_only=False) if self.blank_joins else np.zeros(len(texts), bool)
        lists = self._parts(pc.if_else(pa.array(odd), "", texts))
        words = lists.flatten().dictionary_encode()
        ids = self._learn(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, ends, data = pa.array(ids, pa.large_binary()).take(words.indices).buffers()
        places = np.frombuffer(ends, dtype=np.int64)[: len(words) + 1] // self.type.itemsize
        all_ids = np.frombuffer(data or b"", dtype=self.type)
        cuts = places[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        first = int(self.blank_joins)
        out = []
        for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if odd[number]:
                out.append(np.append(self._ids([texts[number].as_py()])[0], end))
            else:
                out.append(np.append(all_ids[a + first : b] if b > a else all_ids[a:b], end))
        return out


@functools.cache
def encoder(path: str, blank_joins: bool) -> Encoder:
    """One encoder a worker process, whose tasks share the words seen."""
    return Encoder(path, blank_joins)


@caches.drops
def _drop_encoders() -> None:
    encoder.cache_clear()


def crc_of_ids(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
