"""Abusive, hateful or sexual content (problem 8).

Terms and the words of frames lie in one lexicon trie. Every distinct token of a text runs through a Levenshtein
automaton intersected with the trie, whose input symbols are sets of letters, so that substituted digits and signs,
masked letters, repeated letters and look-alike letters of other scripts cost nothing and a misspelling (a letter
missing, added, changed or two swapped) costs one edit. Words of a public vocabulary are no misspellings. A hit is
scored by its context window: words that address or point at a person or make a term sexual raise it; words that talk
about the term, its dictionary senses, and quotation within a report lower it. Frames (sequences of such words with
gaps) and statements about groups of people are scored by the same window.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm import lexicon as L
from boxlake.llm.words import unwrapped

#: From this score on a text counts as abusive.
THRESHOLD = 0.5
#: Words on each side of a hit that are its context, within its sentence; words beside it that show a technical use.
WINDOW, BESIDE = 14, 5
#: Weights: a strong or weak term, an uncertain (misspelled or masked) one, a frame; what the context adds or takes.
STRONG, WEAK, UNSURE, FRAME = 0.6, 0.25, 0.3, 0.7
DIRECT, SEXUAL, TECHNICAL, QUOTED = 0.4, 0.35, -0.5, -0.5
#: Weights of words that degrade a group: at once, and in company.
DEGRADES, DEGRADES_WITH, OF_ALL = 0.55, 0.3, 0.25
#: Shortest token that may be a misspelling; shortest that may have another first letter.
EDIT_FROM, EDIT_FIRST_FROM = 4, 6
#: A public vocabulary whose whole words are never taken for misspellings.
VOCABULARY = os.environ.get("BOXLAKE_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOK_ALIKE = str.maketrans("абвгеѕіјкмнорстухԁһԛԝɡαεικνορτυχ", "abbreſijkmhopctyxdhqwgaeiknoptux".replace("ſ", "s"))
SIGNS = {"@": "a", "4": "a", "$": "s", "5": "s", "0": "o", "1": "il", "!": "il", "3": "e", "€": "e", "7": "t", "+": "t", "8": "b", "9": "g", "6": "g", "2": "z"}
MASKS = "*#%?"

#: Endings that a word of the vocabulary may have and still be ordinary.
ENDINGS = ("s", "es", "d", "ed", "r", "er", "ing", "ly", "n", "en", "e", "t", "em", "o", "a")

_TOKEN = re.compile(r"[^\s,;:()\"“”„«»‚‘’`´'/\\\-–—…<>\[\]{}=|&~^¡¿]+")
_SENTENCE = re.compile(r"[\n\r]+|(?<=[.!?])(?<!\W\w\.)\s+|\s{3,}")
_DOTTED = re.compile(r"(?:[^\W_][._·*])+[^\W_]{1,4}")
_RUN = re.compile(r"(.)\1{2,}")
_QUOTE = re.compile(r"\"[^\"]*\"|“[^”]*”|„[^“”]*[“”]|«[^»]*»|(?<!\w)'[^']*'(?!\w)")


class Lexicon:
    """The trie of terms and frame words, and the frames over bits that the words' slots have."""

    def __init__(self) -> None:
        self.bits: dict[frozenset[str], int] = {}
        masks: dict[str, int] = {}

        def slot(text: str) -> int:
            words = frozenset(L.CLASSES[text[1:]].split() if text.startswith("@") else text.split("|"))
            if words not in self.bits:
                self.bits[words] = 1 << len(self.bits)
                for w in words:
                    masks[w] = masks.get(w, 0) | self.bits[words]
            return self.bits[words]

        named = lambda words: slot("|".join(words))
        self.you, self.group, self.all = slot("@YOU"), named(L.GROUPS), named(L.ALL)
        self.strong, self.weak = named(L.DEGRADING_STRONG), named(L.DEGRADING_WEAK)
        self.frames: dict[int, list[tuple[str, list[tuple[int, int]], int]]] = {}
        for kind, texts in (*L.FRAMES.items(), ("insult", L.INSULT_FRAMES), ("group", L.GROUP_FRAMES)):
            for text in texts:
                slots, gap, anchor = [], 0, 0
                for part in text.split():
                    if part[0] == "~":
                        gap = int(part[1:])
                        continue
                    bit = slot(part.lstrip("!"))
                    anchor = bit if part[0] == "!" else anchor
                    slots.append((bit, gap))
                    gap = 0
                whole = 0
                for bit, _ in slots:
                    whole |= bit
                self.frames.setdefault(anchor, []).append((kind, slots, whole))
        self.anchors = 0
        for bit in self.frames:
            self.anchors |= bit
        self.trie: dict = {}
        self.tails: set[str] = set()
        for kind, terms in (("is", L.INSULT_STRONG), ("ss", L.SEXUAL_STRONG), ("iw", L.INSULT_WEAK), ("sw", L.SEXUAL_WEAK)):
            for term in terms:
                for form in (term, term + "s", term + "es", term + "e", term + "en", term + "n"):
                    self._add(form, 0, (kind, term), form == term)
        for word, mask in masks.items():
            self._add(word, mask, None, True)

    def _add(self, word: str, mask: int, hit: tuple[str, str] | None, own: bool) -> None:
        node = self.trie
        for c in word:
            node = node.setdefault(c, {})
        held_mask, held = node.get("", (0, None))
        node[""] = (held_mask | mask, hit if hit and (own or held is None) else held)
        self.tails.update(word[-k:] for k in range(1, len(word) + 1))


def _accepted(trie: dict, symbols: list[str], edits: int) -> list[tuple[int, str, tuple[int, tuple[str, str] | None]]]:
    """[(edits, word, payload)] of all words that a Levenshtein automaton over sets of letters accepts."""
    n, out = len(symbols), {}
    seen = {(id(trie), 0, 0)}
    stack = [(trie, 0, 0, "")]
    while stack:
        node, i, e, word = stack.pop()
        if i == n and "" in node and out.get(word, (9,))[0] > e:
            out[word] = (e, node[""])
        steps = []
        if i < n:
            letters = symbols[i]
            if letters == "*":
                steps += [(child, i + 1, e, word + c) for c, child in node.items() if c]
            else:
                steps += [(node[c], i + 1, e, word + c) for c in letters if c in node]
        if e < edits:
            steps += [(child, i, e + 1, word + c) for c, child in node.items() if c]
            if i < n:
                steps.append((node, i + 1, e + 1, word))
                steps += [(child, i + 1, e + 1, word + c) for c, child in node.items() if c]
            if i + 1 < n and symbols[i] != "*" and symbols[i + 1] != "*":  # two letters swapped
                steps += [(node[c][d], i + 2, e + 1, word + c + d) for c in symbols[i + 1] if c in node for d in symbols[i] if d in node[c]]
        for s in steps:
            k = (id(s[0]), s[1], s[2])
            if k not in seen:
                seen.add(k)
                stack.append(s)
    return [(e, w, p) for w, (e, p) in out.items()]


def ordinary_words(path: str) -> frozenset[str]:
    """The whole words of a vocabulary file (tokens that begin with a space), lower case, of letters only."""
    out = set()
    with open(path, "rb") as f:
        for line in f:
            token = base64.b64decode(line.split()[0]) if line.strip() else b""
            if token[:1] == b" " and len(token) > EDIT_FROM:
                word = unwrapped(token[1:].decode("utf-8", "ignore")).lower()
                if word.isalpha():
                    out.add(word)
    return frozenset(out)


class Reader:
    """Reads tokens against the lexicon; a token's reading is remembered, as most tokens come again."""

    KEPT = 300_000

    def __init__(self, ordinary: frozenset[str] = frozenset(), edits: int = 1) -> None:
        self.lexicon, self.ordinary, self.edits = Lexicon(), ordinary | frozenset(L.ORDINARY), edits
        self.longest = max(map(len, self.lexicon.tails))
        self.known: dict[str, tuple[int, tuple[str, str, float] | None] | None] = {}
        self.directed, self.sexual, self.mention, self.report = (frozenset(x) for x in (L.DIRECTED, L.SEXUAL_CUES, L.MENTION, L.REPORT))
        self.mention_of_frame = frozenset(L.MENTION_OF_FRAME)
        self.pointing, self.utter, self.kind_of, self.follows = (frozenset(x) for x in (L.POINTING, L.UTTER, L.KIND_OF, L.FOLLOWS))
        self.literal = {k: frozenset(v.split()) for k, v in L.LITERAL.items()}

    def read(self, token: str) -> tuple[int, tuple[str, str, float] | None] | None:
        """(slots the token fills, (kind, term, certainty) or None), or None for a token without meaning here."""
        try:
            return self.known[token]
        except KeyError:
            pass
        if len(self.known) >= self.KEPT:
            self.known.clear()
        self.known[token] = found = self._read(token)
        return found

    def _read(self, token: str) -> tuple[int, tuple[str, str, float] | None] | None:
        if _DOTTED.fullmatch(token) and token.count("*") < 2:
            token = re.sub(r"[._·*]", "", token)
        forms = dict.fromkeys([token, *([_RUN.sub(r"\1", token), _RUN.sub(r"\1\1", token)] if _RUN.search(token) else [])])
        mask, best = 0, None
        for form in forms:
            masks = sum(c in MASKS for c in form)
            letters = sum(c.isalpha() for c in form)
            if not 1 <= len(form) <= self.longest + 1 or not letters or (masks and len(form) - masks < 2):
                continue
            symbols = ["*" if c in MASKS else SIGNS.get(c, c) for c in form]
            exact = _accepted(self.lexicon.trie, symbols, 0)
            for _, _, (slots, hit) in exact:
                mask |= slots if masks * 3 <= len(form) else 0
                sure = 1.0 if masks * 3 <= len(form) else 0.5
                if hit and (best is None or sure > best[2]):
                    best = (*hit, sure)
            if not exact and self.edits and not masks and len(form) >= EDIT_FROM and letters * 3 >= len(form) * 2 and not self._ordinary(form) and self._near(form):
                for _, word, (slots, hit) in _accepted(self.lexicon.trie, symbols, self.edits):
                    if len(word) < EDIT_FROM or (len(form) < EDIT_FIRST_FROM and word[0] not in symbols[0]):
                        continue
                    # A weak sexual term is too common a word to be guessed.
                    if hit and best is None and hit[0] != "sw":
                        best = (*hit, 0.5)
                    if len(word) > EDIT_FROM:
                        mask |= slots
        return (mask, best) if mask or best else None

    def _ordinary(self, form: str) -> bool:
        """Whether the token is a word of the vocabulary, as it stands or without an ending."""
        return form in self.ordinary or any(form.endswith(x) and (form[: -len(x)] in self.ordinary or form[: -len(x)] + "e" in self.ordinary) for x in ENDINGS)

    def _near(self, form: str) -> bool:
        """Whether one edit may make the token a word: then one half of it is already the word's beginning or end."""
        node, half, n = self.lexicon.trie, len(form) // 2, 0
        for c in form:
            node = next((node[x] for x in SIGNS.get(c, c) if x in node), None)
            if node is None:
                break
            n += 1
        return n >= half - 1 or form[half + 1 :] in self.lexicon.tails

    def passages(self, text: str) -> list[tuple[float, str]]:
        """(score, kind) of every sentence with a hit."""
        out = []
        for sentence in _SENTENCE.split(unwrapped(text).translate(LOOK_ALIKE).casefold().translate(LOOK_ALIKE)):
            found = self._sentence(sentence)
            if found is not None:
                out.append(found)
        return out

    def _sentence(self, sentence: str) -> tuple[float, str] | None:
        tokens = [t for t in (t.strip(".!?*_~#•") for t in _TOKEN.findall(sentence)) if t]
        if not tokens:
            return None
        tokens = self._spelled(tokens)
        if any(c in sentence for c in MASKS + "_"):
            tokens = [part for t in tokens for part in self._divided(t)]
        readings = [self.read(t) for t in tokens]
        held, terms = 0, []
        for i, r in enumerate(readings):
            if r is not None:
                held |= r[0]
                if r[1] is not None:
                    terms.append((i, r[1]))
        lex = self.lexicon
        degrading = held & (lex.strong | lex.weak)
        if not terms and not held & lex.anchors and not degrading:
            return None
        slots = [r[0] if r is not None else 0 for r in readings]
        frames = self._frames(slots, held) if held & lex.anchors else []
        quoted = self._quoted(sentence, tokens)
        best = (0.0, "")
        for i, h in terms:
            best = max(best, self._scored(tokens, slots, i, h, quoted))
        people = bool(held & lex.group)
        for kind, i, j in frames:
            if kind == "group":
                people = True
                continue
            score = FRAME + 0.1 * bool(held & lex.you) + self._lowered(tokens, i, j, quoted, self.mention_of_frame)
            best = max(best, (max(0.0, score), kind))
        if people and degrading:
            best = max(best, (self._degraded(tokens, slots, held, quoted), "hate"))
        return best if best[0] > 0 or terms or frames else None

    def _frames(self, slots: list[int], held: int) -> list[tuple[str, int, int]]:
        """(kind, first, last token) of every frame that the tokens fill."""
        out = []
        anchors = held & self.lexicon.anchors
        while anchors:
            bit = anchors & -anchors
            anchors ^= bit
            for kind, frame, whole in self.lexicon.frames[bit]:
                if whole & held == whole:
                    for i, m in enumerate(slots):
                        if m & frame[0][0] and (j := self._follow(slots, frame, i)) >= 0:
                            out.append((kind, i, j))
                            break
        return out

    @staticmethod
    def _follow(slots: list[int], frame: list[tuple[int, int]], start: int) -> int:
        """The last token of a frame that begins at `start`, or -1."""
        ends = {start}
        for bit, gap in frame[1:]:
            ends = {k for j in ends for k in range(j + 1, min(len(slots), j + 2 + gap)) if slots[k] & bit}
            if not ends:
                return -1
        return min(ends)

    def _quoted(self, sentence: str, tokens: list[str]) -> frozenset[str]:
        """Tokens that stand only within quotation marks of a sentence that reports what was said; else none."""
        if self.report.isdisjoint(tokens):
            return frozenset()
        inside = " ".join(m[0] for m in _QUOTE.finditer(sentence))
        if not inside:
            return frozenset()
        plain = lambda text: {t.strip(".!?*_~#•") for t in _TOKEN.findall(text)}
        outside = plain(_QUOTE.sub(" ", sentence))
        return frozenset(plain(inside) - outside) if not self.report.isdisjoint(outside) else frozenset()

    def _lowered(self, tokens: list[str], i: int, j: int, quoted: frozenset[str], mention: frozenset[str]) -> float:
        """What the context of tokens i..j takes away: they are quoted in a report, or words beside them mention them."""
        if quoted and any(t in quoted for t in tokens[i : j + 1]):
            return QUOTED
        beside = tokens[max(0, i - 2) : i] + tokens[j + 1 : j + 3]
        return 0.0 if mention.isdisjoint(beside) else TECHNICAL

    def _divided(self, token: str) -> list[str]:
        """The words of a token that signs join, where it has no reading as a whole."""
        if len(token) < 2 * EDIT_FROM or self.read(token):
            return [token]
        parts = [p for p in re.split(r"[*#%?_]+", token) if p]
        return parts if len(parts) > 1 and all(len(p) >= EDIT_FROM and p.isalpha() for p in parts) else [token]

    def _spelled(self, tokens: list[str]) -> list[str]:
        """Joins three or more single letters in a row, as in words spelled with spaces.

        One-letter words may stand before and behind: the longest parts that are words of the lexicon are joined, found
        by a window over the row; a row without any is joined whole.
        """
        if sum(len(t) == 1 for t in tokens) < 3:
            return tokens
        out, row = [], []
        for t in [*tokens, ""]:
            if len(t) == 1 and (t.isalpha() or t in SIGNS or t in MASKS):
                row.append(t)
                continue
            if len(row) >= 3:
                made, i = [], 0
                while i < len(row):
                    size = next((k for k in range(min(len(row) - i, self.longest), 2, -1) if self.read("".join(row[i : i + k]))), 0)
                    made.append("".join(row[i : i + size]) if size else row[i])
                    i += size or 1
                row = made if any(len(x) > 1 for x in made) else ["".join(row)]
            out += row
            row = []
            if t:
                out.append(t)
        return out

    def _degraded(self, tokens: list[str], slots: list[int], held: int, quoted: frozenset[str]) -> float:
        """The score of a statement about a group of people: what is said of it, and whether of all of it."""
        at = [i for i, m in enumerate(slots) if m & (self.lexicon.strong | self.lexicon.weak)]
        strong, weak = sum(bool(slots[i] & self.lexicon.strong) for i in at), len({tokens[i] for i in at if slots[i] & self.lexicon.weak})
        score = DEGRADES * (strong > 0) + 0.1 * (strong > 1) + DEGRADES_WITH * weak + OF_ALL * bool(weak and held & self.lexicon.all)
        return max(0.0, min(1.0, score + min(self._lowered(tokens, i, i, quoted, frozenset()) for i in at)))

    def _scored(self, tokens: list[str], slots: list[int], i: int, hit: tuple[str, str, float], quoted: frozenset[str]) -> tuple[float, str]:
        kind, term, sure = hit
        around = tokens[max(0, i - WINDOW) : i] + tokens[i + 1 : i + 1 + WINDOW]
        beside = tokens[max(0, i - BESIDE) : i] + tokens[i + 1 : i + 1 + BESIDE]
        behind = tokens[i + 1] if i + 1 < len(tokens) else ""
        score = STRONG if kind[1] == "s" else WEAK
        if sure < 1:
            score = min(score, UNSURE)
        cues = sum(t in self.sexual for t in set(around))
        if kind[0] == "i":
            you = any(m & self.lexicon.you for m in slots[max(0, i - WINDOW) : i] + slots[i + 1 : i + 1 + WINDOW])
            pointed = not self.pointing.isdisjoint(tokens[max(0, i - 2) : i]) or (i > 1 and tokens[i - 1] == "of" and tokens[i - 2] in self.kind_of)
            utter = i > 0 and tokens[i - 1] in self.utter
            speaks = you or utter or not self.directed.isdisjoint(around) or (pointed and (not behind or behind in self.follows))
            score += DIRECT * speaks
        else:
            speaks = cues > 1
            score += SEXUAL * (cues > 0) + 0.15 * (cues > 1)
        # A mention or a literal sense beside the term tells its use, unless the sentence speaks to a person.
        literal = self.literal.get(term, frozenset())
        technical = not self.mention.isdisjoint(beside) or not literal.isdisjoint(beside)
        if (technical and not speaks) or behind in self.mention or behind in literal:
            score += TECHNICAL
        if tokens[i] in quoted:
            score += QUOTED
        return max(0.0, min(1.0, score)), "insult" if kind[0] == "i" else "sexual"


_READERS: list[Reader] = []


def abuse_scores(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, *keep, abuse_score, abuse_kind, n_abusive) of every row of documents.

    abuse_score is the highest score of any sentence in the whole text, abuse_kind its kind (threat, hate, sexual or
    insult; null without a hit), n_abusive the sentences from THRESHOLD on. Null and empty texts score 0; repeated
    rows are scored alike and all returned; a row without an id keeps its null id. There is no shuffle. The vocabulary
    is shipped to the executors with the job.
    """
    documents.sparkSession.sparkContext.addFile(vocabulary)
    shipped = os.path.basename(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _READERS:
            _READERS.append(Reader(ordinary_words(SparkFiles.get(shipped))))
        reader = _READERS[0]
        for batch in batches:
            scores, kinds, counts = [], [], []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                found = reader.passages(t) if t else []
                best = max(found, default=(0.0, None))
                scores.append(round(best[0], 6))
                kinds.append(best[1] if best[0] else None)
                counts.append(sum(s >= THRESHOLD for s, _ in found))
            made = [pa.array(scores, pa.float64()), pa.array(kinds, pa.string()), pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names)

    rows = documents.select(F.col(f"`{doc_id}`"), *[F.col(f"`{k}`") for k in keep], F.col(f"`{text}`").alias("__text"))
    names = [*rows.columns[:-1], "abuse_score", "abuse_kind", "n_abusive"]
    schema = rows.drop("__text").schema.add("abuse_score", "double").add("abuse_kind", "string").add("n_abusive", "integer")
    return rows.mapInArrow(run, schema)
