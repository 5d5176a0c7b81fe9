"""Free-typed values mapped to a canonical list.

An automaton over canonical names and their aliases finds mentions embedded in the folded value; the longest
non-overlapping one wins. What it doesn't settle goes to a token-set similarity that forgives typing
errors, phonetic spelling, abbreviations and joined words. Values without a clear entry map to none.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import fold as fold_text
from tamiz.functions.text import is_blank
from tamiz.llm.encodings import LOST, chains, restore, undo
from tamiz.operators.skew import skewed_lookup
from tamiz.session import cut

#: A word of no name is noise if it stands beside the mentions of so many entries, in this share of the values that have anything beside a mention.
NOISE_ENTRIES, NOISE_SHARE = 3, 0.01
_FOLD_SEPARATORS = re.compile(r"[^a-z0-9?]+")

#: Least similarity of an accepted match, and how far the next entry must be behind.
LEAST, MARGIN = 0.74, 0.015


def fold(text: str) -> str:
    """Lower case without marks; lost characters become a question mark."""
    t = unicodedata.normalize("NFD", text.lower().replace(LOST, "?"))
    return "".join(c for c in t if not "\u0300" <= c <= "\u036F")


@lru_cache(maxsize=200_000)
def sound(word: str) -> str:
    """Spelling by sound: b/v, ll/y, c/s/z, qu/k, ch/sh/x alike, h silent, doubled letters single."""
    w = word.replace("qu", "k").replace("ch", "x").replace("sh", "x").replace("ll", "y").replace("v", "b").replace("z", "s")
    w = re.sub(r"c(?=[ei])", "s", w).replace("h", "")
    return re.sub(r"(.)\1+", r"\1", w)


@lru_cache(maxsize=200_000)
def _places(a: str) -> tuple[dict[str, int], int]:
    """Bit set of the places of each character of `a`, and of its wildcards."""
    bits: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(a):
        bits[ch] |= 1 << i
    wild = bits.pop("?", 0)
    return {ch: x | wild for ch, x in bits.items()}, wild


def distance(a: str, b: str) -> int:
    """Edits with neighbouring swaps, bit-parallel; `?` stands for any character."""
    if not a or not b:
        return len(a) + len(b)
    bits, wild = _places(a)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, zero, last, dist = full, 0, 0, 0, len(a)
    for ch in b:
        eq = full if ch == "?" else bits.get(ch, wild)
        swap = ((~zero & eq) << 1) & last & full
        zero = ((((eq & up) + up) ^ up) | eq | down | swap) & full
        right, left = (down | ~(zero | up)) & full, zero & up
        dist += bool(right & top) - bool(left & top)
        right, left = ((right << 1) | 1) & full, (left << 1) & full
        up, down, last = (left | ~(zero | right)) & full, right & zero, eq
    return dist


@lru_cache(maxsize=200_000)
def _bag(word: str) -> int:
    """The word's characters as a bit set, each up to four times."""
    out = 0
    for ch in word:
        out |= 1 << 4 * (ord(ch) % 64) + min(3, (out >> 4 * (ord(ch) % 64) & 15).bit_count())
    return out


#: Words less alike than this count as different.
ALIKE = 0.6


@lru_cache(maxsize=500_000)
def likeness(a: str, b: str) -> float:
    """1 for equal sounds, down to ALIKE, else 0; the better of spelling and sound.

    Every character that one word has more often than the other costs an edit, so most pairs are settled by their bags.
    """
    best = 0.0
    for x, y in {(a, b), (sound(a), sound(b))}:
        n = max(len(x), len(y))
        if not n or abs(len(x) - len(y)) > n // 2:
            continue
        most = n - n * max(best, ALIKE)
        p, q = _bag(x), _bag(y)
        if "?" in x or "?" in y or max((p & ~q).bit_count(), (q & ~p).bit_count()) <= most + 1e-9:
            best = max(best, 1 - distance(x, y) / n)
    return best if best >= ALIKE else 0.0


class Bags:
    """The character bags of many words, compared with one word's at once."""

    #: Up to so many words the comparison with all of them is kept for each typed word.
    KEPT = 2000

    def __init__(self, words: list[str]):
        import numpy as np

        self.any = np.array(["?" in w for w in words], bool)
        self.sides = [self._side(v) for v in (words, list(map(sound, words)))]
        self.kept: dict = {}

    @staticmethod
    def _side(words: list[str]):
        """(the bags in four lanes of 64 bits, lengths)."""
        import numpy as np

        bags = list(map(_bag, words))
        lanes = [np.array([b >> 64 * i & (1 << 64) - 1 for b in bags], np.uint64) for i in range(4)]
        return lanes, np.array([len(w) for w in words], np.int64)

    def most(self, word: str, ids):
        """An upper bound of `likeness` of the word to each of the words `ids`; 0 where that can't reach ALIKE."""
        if len(self.any) > self.KEPT:
            return self.compared(word, ids)
        # Beside a short list a typed word is compared with all of it once.
        if word not in self.kept:
            self.kept[word] = self.compared(word, slice(None))
        return self.kept[word][ids]

    def compared(self, word: str, ids):
        import numpy as np

        out = 0.0
        for v, (lanes, sizes) in zip((word, sound(word)), self.sides):
            (mine, n), size = self._side([v]), sizes[ids]
            more = less = 0
            for a, b in zip(lanes, mine):
                both = a[ids] & b
                more, less = more + np.bitwise_count(both ^ b), less + np.bitwise_count(both ^ a[ids])
            longest = np.maximum(np.maximum(size, n), 1)
            top = 1.0 if "?" in v else np.where(self.any[ids], 1.0, 1 - np.maximum(more, less) / longest)
            out = np.maximum(out, np.where(np.abs(size - n) <= longest // 2, top, 0))
        return np.where(out > ALIKE - 1e-9, out, 0)


class Matcher:
    """Maps values to `entries`, pairs of id and name; ids of equal names resolve to the smallest.

    `noise` are words that stand around names and name nothing, as `noise_words` finds them.
    """

    def __init__(self, entries: list[tuple[int, str]], noise: frozenset[str] = frozenset()):
        import ahocorasick
        import numpy as np

        self.noise = noise

        self.exact: dict[str, int] = {}
        for i, name in sorted(entries):
            self.exact.setdefault(name, i)
        self.names = [(i, _FOLD_SEPARATORS.sub(" ", fold(n)).strip().split()) for n, i in self.exact.items()]
        first = Counter(t[0] for _, t in self.names if len(t) > 1)
        self.kinds = {w for w, n in first.items() if n >= 3}
        owners = Counter(" ".join(t[1:]) for _, t in self.names if len(t) > 1 and t[0] in self.kinds)
        plain = {" ".join(t) for _, t in self.names}
        self.automaton = ahocorasick.Automaton()
        for i, t in sorted(self.names, key=lambda x: (x[1], -x[0])):
            self._alias(" ".join(t), i)
            core = " ".join(t[1:])
            if len(t) > 1 and t[0] in self.kinds and owners[core] == 1 and core not in plain and len(core) > 3:
                self._alias(core, i)
        if self.names:
            self.automaton.make_automaton()
        self.own_words = {w for _, t in self.names for w in t}
        self.grams: dict[str, set[int]] = defaultdict(set)
        #: Length by sound and by spelling of each name without blanks; names by these.
        self.sizes = [(len("".join(map(sound, t))), len("".join(t))) for _, t in self.names]
        self.by_size: dict[tuple[int, int], list[int]] = defaultdict(list)
        for k, (_, t) in enumerate(self.names):
            self.by_size[self.sizes[k]].append(k)
            for g in self._bigrams("".join(map(sound, t))):
                self.grams[g].add(k)
        self.sorted_words = sorted(self.own_words)
        place = {w: i for i, w in enumerate(self.sorted_words)}
        self.bags, self.joined = Bags(self.sorted_words), Bags(["".join(t) for _, t in self.names])
        self.tokens_of = [[place[w] for w in t] for _, t in self.names]
        self.weights = np.array([len(w) * (0.35 if w in self.kinds else 1.0) for w in self.sorted_words])
        self.cache: dict[str, int] = {}
        self.shorts: dict[str, str] = {}
        self.decided: dict[tuple[str, ...], int] = {}

    def _alias(self, text: str, i: int) -> None:
        self.automaton.add_word(f" {text} ", (len(text), i))

    @staticmethod
    def _bigrams(s: str) -> set[str]:
        return {s[k : k + 2] for k in range(len(s) - 1)}

    @staticmethod
    def split(folded: str) -> list[str]:
        """A folded value at its separators, then what stands in brackets."""
        texts = [re.sub(r"\([^)]*\)?", " ", folded), *re.findall(r"\(([^)]*)\)?", folded)]
        return [x for text in texts for x in re.split(r",|(?:\A|\s)-\s|;|\s/\s", text)]

    @classmethod
    def parts(cls, value: str) -> list[str]:
        """The parts of a value, wrong encodings that prove themselves undone."""
        return cls.split(fold(restore(value, []) or value))

    @staticmethod
    def _least_shared(sounds: int, letters: int, name_sounds: int, name_letters: int) -> float:
        """Bigrams that a value shares at least with a name as alike as LEAST, from the lengths of both; 0 or less: maybe none.

        Of names of about the same length so many edits are forgiven, and each, as a swap, may break three bigrams.
        Names of another length are only alike by whole words, which leave a fifth of the shorter side.
        """
        short = min(sounds, name_sounds)
        edits = int((1 - LEAST) * max(letters, name_letters))
        bound = 0.2 * short
        return min(bound, short - 1 - 3 * edits) if abs(letters - name_letters) <= edits else bound

    def expanded(self, w: str) -> str:
        """The word that many names begin with for which `w` stands, else `w` itself.

        An abbreviation is the beginning of the word, or keeps some of its letters in order with the first and the last among them;
        a beginning and a shorter word come first, and two that are equally good leave it as it is.
        """
        if w not in self.shorts:
            fit = []
            if w and w.isalpha() and w not in self.own_words and w not in self.noise:
                for k in self.kinds:
                    letters = iter(k)
                    if len(w) < len(k) and k[0] == w[0] and (k.startswith(w) or (k[-1] == w[-1] and all(ch in letters for ch in w))):
                        fit.append((not k.startswith(w), len(k), k))
            fit.sort()
            self.shorts[w] = w if not fit or (len(fit) > 1 and fit[0][:2] == fit[1][:2]) else fit[0][2]
        return self.shorts[w]

    def tokens(self, t: str) -> tuple[list[str], set[str]]:
        """Words of a part of a value that may name an entry, and those of them written as abbreviations."""
        short = {m.group(1) for m in re.finditer(r"([a-z]+)\.", t)}
        words = [self.expanded(w) for w in _FOLD_SEPARATORS.sub(" ", t).split()]
        words = [w for w in words if not w.isdigit() and w != "?"]
        while len(words) > 1 and words[0] in self.noise and words[0] not in self.own_words:
            words.pop(0)
        while len(words) > 1 and words[-1] in self.noise and words[-1] not in self.own_words:
            words.pop()
        return words, {w for w in short if self.expanded(w) == w}

    def beside(self, value: str) -> tuple[int, set[str]]:
        """(id, other words) of the first part of a value with a mention and something else; 0 and nothing without one.

        Only words that no name has count, the mention itself aside.
        """
        for part in re.split(r"[,;()]|(?:\A|\s)-\s|\s/\s", fold(value)):
            words = [self.expanded(w) for w in _FOLD_SEPARATORS.sub(" ", part).split()]
            found = self.mentions(words)
            if found and found[0][0] < len(" ".join(words)):
                return found[0][1], {w for w in words if w.isalpha() and w not in self.own_words}
        return 0, set()

    def mentions(self, words: list[str]) -> list[tuple[int, int]]:
        """(length, id) of the longest non-overlapping mentions, longest first."""
        if not self.names:
            return []
        text = " " + " ".join(words) + " "
        spans = []
        for end, (n, i) in self.automaton.iter(text):
            spans.append((n, end - n, i))
        taken: list[tuple[int, int, int]] = []
        for n, start, i in sorted(spans, key=lambda x: (-x[0], x[1])):
            if all(start + n <= s or start >= s + m for m, s, _ in taken):
                taken.append((n, start, i))
        return [(n, i) for n, _, i in taken]

    def similarity(self, words: list[str], short: set[str], target: list[str]) -> float:
        """Soft token-set similarity of the value's words and an entry's."""
        weight = lambda w: len(w) * (0.35 if w in self.kinds else 1.0)
        mine = [w for w in words if w not in self.noise or w in target] or words
        free = list(target)
        hit_mine = hit_target = 0.0
        for w in sorted(mine, key=lambda x: -len(x)):
            best, who = 0.0, None
            for t in free:
                s = likeness(w, t)
                if len(w) > 1 and t.startswith(w):
                    s = max(s, 1.0 if w in short else 0.85 if len(w) > 3 else 0.0)
                if s > best:
                    best, who = s, t
            if who is not None and best >= ALIKE:
                free.remove(who)
                hit_mine += weight(w) * best
                hit_target += weight(who) * best
        p = hit_mine / max(1e-9, sum(map(weight, mine)))
        r = hit_target / max(1e-9, sum(map(weight, target)))
        score = 2 * p * r / (p + r) if p + r else 0.0
        if p >= 0.8 and r >= 0.4 and any(w not in self.kinds for w in mine):
            # All that was written belongs to the entry, which has more words.
            score = max(score, 0.5 * p + 0.5 * max(r, 0.55))
        joined = likeness("".join(words), "".join(target))
        return max(score, joined if len("".join(words)) > 3 else 0.0)

    def _near(self, need: list[int], words: list[str], short: set[str], whole: str) -> list[tuple[float, int]]:
        """(bound, entry) of those whose `similarity` may come within MARGIN of LEAST, highest first; scores below that decide nothing.

        The bounds of all are taken at once: each word counts with the most it may be alike to any word of the other side.
        """
        import numpy as np

        need = [k for k in need if self.tokens_of[k]]
        if not need:
            return []
        sizes = [len(self.tokens_of[k]) for k in need]
        ids = np.array([i for k in need for i in self.tokens_of[k]])
        starts = np.cumsum([0, *sizes[:-1]])
        of_target = np.zeros(len(ids))
        core, every = np.zeros((2, len(need))), np.zeros(2)
        for w in words:
            most = self.bags.most(w, ids)
            if len(w) > 1 and (w in short or len(w) > 3):
                low, high = bisect_left(self.sorted_words, w), bisect_left(self.sorted_words, w + "\U0010ffff")
                most = np.where((ids >= low) & (ids < high), np.maximum(most, 1.0 if w in short else 0.85), most)
            of_target = np.maximum(of_target, most)
            gain, weight = np.maximum.reduceat(most, starts), len(w) * (0.35 if w in self.kinds else 1.0)
            for i, counts in enumerate((w not in self.noise, True)):
                if counts:
                    core[i] += weight * gain
                    every[i] += weight
        # Noise counts only where the entry has the word itself.
        p = (core / np.maximum(every, 1e-9)[:, None]).max(0)
        r = np.add.reduceat(of_target * self.weights[ids], starts) / np.maximum(np.add.reduceat(self.weights[ids], starts), 1e-9)
        score = np.maximum(2 * p * r / np.maximum(p + r, 1e-9), np.where(p >= 0.8 - 1e-9, 0.5 * p + 0.5 * np.maximum(r, 0.55), 0))
        if len(whole) > 3:
            score = np.maximum(score, self.joined.compared(whole, np.array(need)))
        return [(float(score[i]), need[i]) for i in np.argsort(-score, kind="stable") if score[i] >= LEAST - MARGIN - 0.01]

    def match(self, value: str) -> int:
        """Id of the entry meant, 0 for none. Blank values are none."""
        if value in self.exact:
            return self.exact[value]
        if value not in self.cache:
            self.cache[value] = self._match(value)
        return self.cache[value]

    def _match(self, value: str) -> int:
        hit = self._text(value)
        if hit or value.isascii():
            return hit
        # Read with the wrong encoding: one that leads to a whole mention is taken.
        for t in dict.fromkeys(t for c in chains() if (t := undo(value, c)) is not None and t != value):
            if words := self.tokens(self.split(fold(t))[0])[0]:
                found = self.mentions(words)
                if found and found[0][0] == len(" ".join(words)):
                    return found[0][1]
        return 0

    def _text(self, value: str) -> int:
        # The first part that means an entry: what stands before the first separator, the rest, the brackets.
        return next((hit for t in self.parts(value) if (hit := self._part(t))), 0)

    def _part(self, part: str) -> int:
        words, short = self.tokens(part)
        if len(words) == 1:
            # Noise run together with the name.
            stuck = next((n for n in sorted(self.noise, key=len, reverse=True) if len(n) > 3 and words[0].startswith(n) and len(words[0]) > len(n) + 3), "")
            if stuck and words[0] not in self.own_words:
                words = [words[0][len(stuck) :]]
        if not any(c.isalpha() for w in words for c in w) or not self.names:
            return 0
        # Spellings that differ in case, marks, blanks or noise come down to the same words.
        key = (*words, "", *sorted(short.intersection(words)))
        if key not in self.decided:
            self.decided[key] = self._decide(words, short)
        return self.decided[key]

    def _decide(self, words: list[str], short: set[str]) -> int:
        text = " ".join(words)
        found = self.mentions(words)
        if found and found[0][0] == len(text):
            return found[0][1]
        s = "".join(map(sound, words))
        shared = Counter(k for g in self._bigrams(s) for k in self.grams.get(g, ()))
        least = {z: self._least_shared(len(s), len("".join(words)), *z) for z in self.by_size}
        need = {k for k, n in shared.items() if n >= least[self.sizes[k]]}
        need.update(k for z, n in least.items() if n <= 0 for k in self.by_size[z])
        scored: list[tuple[float, int]] = []
        top = 0.0
        for bound, k in self._near(sorted(need), words, short, "".join(words)):
            # What can't come within MARGIN of the best so far changes neither the choice nor its clearness.
            if bound >= top - MARGIN - 1e-9 or (found and self.names[k][0] == found[0][1]):
                scored.append((self.similarity(words, short, self.names[k][1]), -self.names[k][0]))
                top = max(top, scored[-1][0])
        scored.sort(reverse=True)
        best = scored[0] if scored else (0.0, 0)
        rest = next((x[0] for x in scored[1:]), 0.0)
        if found:
            # A mention stands unless the value as a whole is closer to an entry that goes on where the mention ends.
            own = next((x for x, i in scored if -i == found[0][1]), 0.0)
            return -best[1] if best[0] >= 0.9 and best[0] > own + 0.03 else found[0][1]
        return -best[1] if best[0] >= LEAST and best[0] - rest >= MARGIN else 0


def resolve(values: DataFrame, entries: DataFrame, max_entries: int = 200_000) -> DataFrame:
    """`valor, ref_id` for the distinct non-null values of `values(valor)`: the id of the entry meant, 0 for none.

    Every distinct value of the whole table is resolved once, wherever it stands; the tasks hold the list, which is counted first
    and refused above `max_entries`.
    """
    rows = entries.where(~is_blank(F.col("nombre")) & F.col("ref_id").isNotNull()).select(F.col("ref_id").cast("bigint"), "nombre").limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"more than {max_entries} entries")
    known = [(r[0], r[1]) for r in rows]
    spark = values.sparkSession
    distinct = values.where("valor is not null").select("valor").distinct()
    # Resolving costs far more than moving: every core gets its share, and spellings of the same words meet.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = cut(distinct.repartition(parts, fold_text(F.col("valor"))))
    noise = noise_words(spread, known)

    def run(batches):
        import pyarrow as pa

        m = Matcher(known, noise)
        for b in batches:
            texts = b.column("valor")
            yield pa.RecordBatch.from_arrays([texts, pa.array([m.match(v) for v in texts.to_pylist()], pa.int64())], ["valor", "ref_id"])

    return cut(spread.mapInArrow(run, "valor string, ref_id bigint"))


def noise_words(values: DataFrame, known: list[tuple[int, str]]) -> frozenset[str]:
    """Words that stand around names in the distinct values of `values(valor)` and name none of `known`.

    They are told by the company they keep: beside mentions of NOISE_ENTRIES entries or more, in NOISE_SHARE of the values
    with anything beside a mention. A value has few words, so few reach that share, whatever the number of values.
    """

    def read(batches):
        import pyarrow as pa

        m = Matcher(known)
        for b in batches:
            found = [m.beside(v) for v in b.column("valor").to_pylist()]
            rows = [(w, i) for i, words in found if i for w in (None, *words)]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([i for _, i in rows], pa.int64())], ["w", "ref_id"])

    near = values.mapInArrow(read, "w string, ref_id bigint").groupBy("w", "ref_id").agg(F.count(F.lit(1)).alias("n"))
    near = cut(near.groupBy("w").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("entries")))
    total = near.where("w is null").agg(F.sum("n")).first()[0] or 0
    often = near.where(F.col("w").isNotNull() & (F.col("entries") >= NOISE_ENTRIES) & (F.col("n") >= NOISE_SHARE * total))
    return frozenset(r[0] for r in often.select("w").collect())


def map_values(cells: DataFrame, entries: DataFrame, max_entries: int = 200_000) -> DataFrame:
    """Add `ref_id` to `cells(.., valor)`: the id of the entry of `entries(ref_id, nombre)` that is meant, else 0.

    Null and blank values are 0, an empty list maps everything to 0. Entries with a null or blank name are
    left out; of equal names the smallest id counts; a `ref_id` that is there already is replaced. Rows find their value's
    entry by a lookup that leaves the rows of a hot value where they are.
    """
    cells = cells.drop("ref_id")
    mapped = skewed_lookup(cells, resolve(cells, entries, max_entries), "valor", "left")
    return mapped.select(*cells.columns, F.coalesce("ref_id", F.lit(0).cast("bigint")).alias("ref_id"))


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 4: every typed place and origin that isn't exactly an entry's name, with the entry meant or 0."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    leads = read("leads_prueba_sintetico_1")
    out = []
    for field, table, key in (("localidad", "localidades_ref", "localidad_id"), ("origen", "origenes_ref", "origen_id")):
        entries = read(table).select(F.col(key).alias("ref_id"), "nombre")
        cells = leads.where(~is_blank(F.col(field))).select("lead_id", F.lit(field).alias("campo"), F.col(field).alias("valor"))
        asked = cells.select("valor").distinct().join(entries.select(F.col("nombre").alias("valor")), "valor", "left_anti")
        # Exact names aren't asked for, so the inner lookup leaves their rows out.
        out.append(skewed_lookup(cells, resolve(asked, entries), "valor").select("lead_id", "campo", "ref_id"))
    return out[0].unionByName(out[1])
