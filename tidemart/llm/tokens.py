"""Texts to token ids by the tokenizers library, with a bounded memory of words.

The vocabularies meant here split at white space before anything else, so a text's ids are those of
its words in a row. Equal words are looked up; new ones of one step are encoded together.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from tidemart.llm.common import resident

#: ASCII capitals to small letters. The normaliser lower-cases as well, so ids stay the same.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Punctuation between an ASCII letter or digit and white space: a piece of its own in any case.
_AFTER_WORD = re.compile(rb"(?<=[a-z0-9])([!-/:-@\[-`{-~]+)(?=[ \n])")
#: Bytes of a simple text: ASCII small letters, digits, white space, comma, full stop, and the Latin-1 letters.
_SIMPLE = bytes([*range(97, 123), *range(48, 58), 9, 10, 11, 12, 13, 32, 44, 46, 0xC3, *range(0x80, 0xC0)])
#: What makes it less simple: punctuation in runs, and the two signs among the letters.
_RUNS = (b",,", b"..", b",.", b".,", b"\xc3\x97", b"\xc3\xb7")
#: Words kept by one Python process. A word is kept when it comes again; that it came is one byte of a table by
#: its hash, which is wiped after so many words. Two words that share a byte only make one of them be kept early.
MEMORY = 300_000
SEEN, WIPE = 1 << 22, 1_500_000


def _is_word_wise(tokenizer: Tokenizer) -> bool:
    """Whether ids of a text are those of its space-separated words, lower-cased first or not."""
    probes = ["Ab cD", "ab, cd.", "é\nÉ x1", "it's a-b ... 'S", "%% x## y"]
    for text in probes:
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        words = text.replace("\n", " ").split(" ")
        lowered = re.sub(r"(?<=[a-z0-9])([!-/:-@\[-`{-~]+)(?=[ \n])", r" \1", text.lower()).replace("\n", " ").split(" ")
        for parts in (words, lowered):
            if whole != [i for w in parts for i in tokenizer.encode(w, add_special_tokens=False).ids]:
                return False
    return True


class WordEncoder:
    """``encode(texts)``: the ids of each text, given as UTF-8, as little-endian unsigned 32-bit integers, without special tokens.

    A vocabulary that does not work word by word is used on whole texts. Strings of added tokens keep
    their meaning: a text that holds one is encoded whole by the library.
    """

    def __init__(self, spec: bytes):
        self.tokenizer = Tokenizer.from_str(spec.decode("utf-8"))
        self.known: dict[bytes, bytes] = {b"": b""}
        self.seen, self.marks = bytearray(SEEN), 0
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values(), default=-1) + 1
        self.ends_word = np.zeros(self.size, dtype=bool)
        for token, i in vocab.items():
            self.ends_word[i] = token.endswith("</w>")
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.word_wise = bool(self.ends_word.any()) and _is_word_wise(self.tokenizer)
        # For words of small letters in composed form, which the normaliser and the split leave as they are.
        self.plain = Tokenizer.from_str(spec.decode("utf-8"))
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )

    def encode(self, texts: list[bytes]) -> list[bytes]:
        known, split, found, missing = self.known.get, [], [], {}
        for text in texts:
            words = self._words(text)
            ids = [] if words is None else list(map(known, words))
            gaps = [i for i, x in enumerate(ids) if x is None]
            for i in gaps:
                missing[words[i]] = None
            split.append((text, words, gaps))
            found.append(ids)
        fresh = self._learn(list(missing))
        for ids, (_, words, gaps) in zip(found, split, strict=True):
            for i in gaps:
                ids[i] = fresh[words[i]]
        self._remember(fresh)
        return [self._whole([t])[0] if w is None else b"".join(x) for x, (t, w, _) in zip(found, split, strict=True)]

    def _remember(self, fresh: dict[bytes, bytes]) -> None:
        """Keeps those of the new words that came before."""
        if len(self.known) + len(fresh) > MEMORY:
            self.known = {b"": b""}
        if self.marks > WIPE:
            self.seen, self.marks = bytearray(SEEN), 0
        seen, known = self.seen, self.known
        for word, ids in fresh.items():
            place = hash(word) & (SEEN - 1)
            if seen[place]:
                known[word] = ids
            else:
                seen[place] = 1
        self.marks += len(fresh)

    def _words(self, text: bytes) -> list[bytes] | None:
        if not self.word_wise:
            return None
        lowered = text.translate(_LOWER)
        if any(token in lowered for token in self.added):
            return None
        if lowered.translate(None, _SIMPLE) or any(run in lowered for run in _RUNS):
            lowered = _AFTER_WORD.sub(rb" \1", lowered)
        else:  # a comma or full stop follows a letter, a digit or white space, so it is a piece of its own
            lowered = lowered.replace(b",", b" ,").replace(b".", b" .")
        return lowered.replace(b"\n", b" ").split(b" ")

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
        return [_little(array("I", e.ids)) for e in found]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        fresh: dict[bytes, bytes] = {}
        joined = b" ".join(new).decode("utf-8")
        # Lower-casing and composing are done here at once; what the library does otherwise to single letters stays with it.
        if unicodedata.is_normalized("NFC", joined) and "\u0130" not in joined and "\u03a3" not in joined:
            small = joined.lower().split(" ")
            letters = [i for i, w in enumerate(small) if w.isalpha()]
            text = " ".join([small[i] for i in letters])
            # One piece for each word of letters, whose last token alone is marked as a word's end.
            ids = array("I", self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids)
            ends = (np.flatnonzero(self.ends_word[np.array(ids, dtype=np.int64)]) + 1) * 4
            if len(ends) == len(letters):
                raw, ends = _little(ids), ends.tolist()
                fresh = dict(zip([new[i] for i in letters], [raw[a:b] for a, b in zip([0, *ends], ends)]))  # noqa: B905
        left = [w for w in new if w not in fresh] if len(fresh) < len(new) else []
        if left:
            fresh.update(zip(left, self._whole(left), strict=True))
        return fresh


def _little(values: array) -> bytes:
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def word_encoder(spec: bytes) -> WordEncoder:
    """The encoder of this process for a vocabulary file's content."""
    return resident(("words", spec), lambda: WordEncoder(spec))
