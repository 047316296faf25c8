"""Token ids by the tokenizers library, word by word where that gives the same ids.

Both vocabularies split a text before a space that stands between two other characters, and encode each
part on its own. So the ids of a text are those of its space-separated parts, and each worker remembers
the ids of parts it has met (``REMEMBERED`` at most; further parts are encoded each time). Where the vocabulary
marks the ends of words, a part of plain letters goes to the library's model without the steps before it, which
change letters one by one: what becomes of each is asked of them once. A single line
break is either another space to the vocabulary or a piece of its own; which, is asked of the library.
Texts with two white-space characters in a row, or one at an end, and texts that hold the string of one of
the vocabulary's added tokens are given to the library whole. The library's settings are left as they are.
"""

from __future__ import annotations

import gc
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from saleslens.llm.common import worker_cache

#: Parts whose ids a worker keeps: a bound on memory (about 200 bytes each), not on what is encoded.
REMEMBERED = 800_000
#: Characters of texts that are cut into parts at once; a longer text is cut alone.
AT_ONCE = 2_000_000
MARK = "~"
_TWO = re.compile(r"\s\s")
_PUNCTUATION = ".,;:!?%*#$&|"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str) -> "Encoder":
    held = worker_cache("tokens")
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


class Encoder:
    """encode(text): the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        added = list(self.library.get_added_tokens_decoder().values())
        # Added tokens are looked for in the text itself; if one is matched after normalisation, all texts go whole.
        self.added = [t.content for t in added]
        self.all_whole = any(t.normalized for t in added)
        self.after_space: dict[str, bytes] = {}
        self.at_start: dict[str, bytes] = {}
        # How the ids of many parts in one text are told apart: by the ids that begin with the space before a
        # part, or else by a mark between parts, if the library gives it one id of its own.
        vocabulary = self.library.get_vocab()
        self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.leads[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.by_space = int(self.leads[self.library.encode(" a b", add_special_tokens=False).ids].sum()) == 2
        mark = self.library.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 and not self.by_space else None
        # Where the vocabulary marks the ends of words, parts of one word each need no mark between them.
        self.ends = np.zeros(len(self.leads), bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.by_end = not self.by_space and int(self.ends[self.library.encode("a b", add_special_tokens=False).ids].sum()) == 2
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.letters: dict[int, str] = {}
        if self.by_end:
            self.letters = self._letters()
        self.plain = re.compile("[" + "".join(map(chr, self.letters)) + "]+") if self.letters else None
        lines, spaces, self.line, apart = self.whole(["a.\nb", "a. b", "\n", "a."])
        self.line_is_space = lines == spaces
        self.line_is_piece = not self.line_is_space and lines == apart + self.line + self.whole(["b"])[0]

    def _letters(self) -> dict[int, str]:
        """What the steps before the model make of each Latin-1 letter; none, if a word isn't what its letters become.
        No Latin-1 letter joins with another one in any normal form, and the case of none depends on its neighbours."""
        def pieces(text: str) -> list[str]:
            n, p = self.library.normalizer, self.library.pre_tokenizer
            text = text if n is None else n.normalize_str(text)
            return [text] if p is None else [x for x, _ in p.pre_tokenize_str(text)]
        alone = {c: pieces(chr(c)) for c in range(256) if chr(c).isalpha()}
        letters = {c: x[0] for c, x in alone.items() if len(x) == 1}
        word = "".join(map(chr, letters))
        if any(pieces(f" {w}") != [w.translate(letters)] or pieces(w) != [w.translate(letters)] for w in (word, word[::-1])):
            return {}
        # The model alone gives what the library gives, or all go the library's way.
        some = ["a", "Word", "unlikelihood", "qzxkjv", *([word] if word else [])]
        alone, self.letters = self.letters, letters
        found, self.letters = self._modelled(some), alone
        return letters if [found.get(w) for w in some] == self.whole([f" {w}" for w in some]) else {}

    def _modelled(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of plain letters by the model, thousands of words in one text; one that isn't told apart is left out."""
        found: dict[str, bytes] = {}
        for lo in range(0, len(words), 1000):
            some = words[lo:lo + 1000]
            found.update(self._apart(some, self.model, " ".join(some).translate(self.letters)))
        return found

    def _apart(self, some: list[str], library: Tokenizer, text: str) -> dict[str, bytes]:
        """Ids of each of some words of a text, told apart by the ends that the vocabulary marks."""
        ids = np.array(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        end = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(end) != len(some) or end[-1] != 4 * len(ids):
            return {}
        raw, cuts = ids.tobytes(), [0, *end.tolist()]
        return dict(zip(some, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))

    def many(self, parts: list[str]) -> list[bytes]:
        """Ids of parts without spaces, each as after a space: encoded by hundreds in one text."""
        plain = [p for p in parts if p and MARK not in p]
        found: dict[str, bytes] = {}
        if self.letters:
            found = self._modelled([p for p in plain if self.plain.fullmatch(p)])
            plain = [p for p in plain if p not in found]
        if self.by_end:
            # Every part has a word at least, so as many ends as parts are one of each.
            words = [p for p in plain if p.isalpha()]
            for lo in range(0, len(words), 1000):
                some = words[lo:lo + 1000]
                found.update(self._apart(some, self.library, " ".join(some)))
            plain = [p for p in plain if p not in found]
        if self.by_space or self.mark is not None:
            for lo in range(0, len(plain), 500):
                some = plain[lo:lo + 500]
                text = "".join(f" {p}" for p in some) if self.by_space else f" {MARK} ".join(some)
                ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                if self.by_space:
                    begin = np.flatnonzero(self.leads[ids])
                    end = np.append(begin[1:], len(ids))
                    whole = len(begin) == len(some) and begin[0] == 0
                else:
                    cuts = np.flatnonzero(ids == self.mark)
                    begin, end = np.append(0, cuts + 1), np.append(cuts, len(ids))
                    whole = len(begin) == len(some)
                if whole:
                    raw = ids.tobytes()
                    found.update(zip(some, [raw[a:b] for a, b in zip((begin * 4).tolist(), (end * 4).tolist())]))
        rest = [p for p in parts if p not in found]
        found.update(zip(rest, self.whole([f" {p}" for p in rest])))
        return [found[p] for p in parts]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[str], known: dict[str, bytes], space: str) -> dict[str, bytes]:
        """Ids of parts that aren't known, and of what stands before their punctuation: A-Z and a-z followed by punctuation
        are two independent parts (other letters can change by normalisation into what is no letter)."""
        need, split = [], []
        for w in parts:
            if w.isalpha():
                need.append(w)
                continue
            core = w.rstrip(_PUNCTUATION)
            if len(core) != len(w) and core.isascii() and core.isalpha():
                split.append((w, core, w[len(core):]))
            else:
                need.append(w)
        asked = set(need)
        need += {c for _, c, _ in split if c not in known and c not in asked}
        tails = [t for t in {t for _, _, t in split} if t not in self.at_start]
        new = dict(zip(need, self.many(need) if space else self.whole(need)))
        new_tails = dict(zip(tails, self.whole(tails)))
        if len(self.at_start) < REMEMBERED:
            self.at_start.update(new_tails)
        new.update([(w, (new[c] if c in new else known[c]) + (new_tails[t] if t in new_tails else self.at_start[t])) for w, c, t in split])
        return new

    def _spaced(self, text: str) -> str | None:
        """The text with its parts between single spaces, the first as at the start and the others as after a space; a part
        that begins with a line break stands after one instead. None: the text has to be encoded whole."""
        if self.all_whole or text[0].isspace() or text[-1].isspace() or _TWO.search(text) or any(t in text for t in self.added):
            return None
        if self.line_is_space:
            return text.replace("\n", " ")
        return text.replace("\n", " \n") if self.line_is_piece else text

    def _missing(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that aren't known after a space or a line break."""
        if not self.line_is_piece:
            return self._learn(parts, self.after_space, " ")
        more = self._learn([w for w in parts if w[:1] != "\n"], self.after_space, " ")
        lines = [w for w in parts if w[:1] == "\n"]
        begun = self._learn([w[1:] for w in lines if w[1:] not in self.at_start], self.at_start, "")
        if len(self.at_start) < REMEMBERED:
            self.at_start.update(begun)
        more.update([(w, self.line + (begun[w[1:]] if w[1:] in begun else self.at_start[w[1:]])) for w in lines])
        return more

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null and empty texts have none."""
        # Millions of words are held and none in a cycle: the search for cycles would walk over them again and again.
        searched = gc.isenabled()
        gc.disable()
        try:
            return self._all(texts)
        finally:
            if searched:
                gc.enable()

    def _all(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        some, size = [], 0
        for t in texts:
            some.append(t)
            size += len(t or "")
            if size >= AT_ONCE:
                out += self._some(some)
                some, size = [], 0
        return out + self._some(some)

    def _some(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        cut = {i: self._spaced(t) for i, t in enumerate(texts) if t}
        long_way = [i for i, x in cut.items() if x is None]
        for i, ids in zip(long_way, self.whole([texts[i] for i in long_way])):
            out[i] = ids
        split = {i: x.partition(" ") for i, x in cut.items() if x is not None}
        first = {x[0] for x in split.values() if x[0] not in self.at_start}
        starts = self._learn(list(first), self.at_start, "") if first else {}
        if len(self.at_start) < REMEMBERED:
            self.at_start.update(starts)
        # Parts are told apart and numbered by Arrow: only distinct ones are looked up.
        parts = pc.split_pattern(pa.array([x[2] if x[1] else None for x in split.values()], pa.large_string()), " ")
        numbered = parts.flatten().dictionary_encode()
        known, distinct = self.after_space, numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(known.get, distinct))
        missing = [w for w, ids in zip(distinct, found) if ids is None]
        if missing:
            more = self._missing(missing)
            found = [more[w] if ids is None else ids for w, ids in zip(distinct, found)]
            if len(known) < REMEMBERED:
                known.update(more)
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin, which = np.cumsum(n) - n, numbered.indices.to_numpy()
        upto = np.cumsum(n[which])
        ids = np.repeat(begin[which] - upto + n[which], n[which])
        ids += np.arange(len(ids))
        raw = np.frombuffer(b"".join(found), "<u4")[ids].tobytes()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(parts), 0).to_numpy())
        lo = 0
        for (i, (head, _, _)), hi in zip(split.items(), np.append(0, 4 * upto)[ends].tolist()):
            out[i] = (starts[head] if head in starts else self.at_start[head]) + raw[lo:hi]
            lo = hi
        return out
