"""Personal data in texts: fixed patterns, and what a linear-chain conditional random field over word shapes adds.

The patterns are e-mail and IP addresses, card and telephone numbers, found from the bytes that they can't do without (@,
runs of digits, +), so that no text, however long, is scanned twice. Matches that fail their check go, and their
characters with them: two numbers side by side hide each other.

The field labels the words between white space as nothing or one of the kinds. Its features are attributes of a word and
of two words on either side: its shape (letters, digits and marks, repeats put together, outer marks aside), how many
digits it has, the word itself where it has none, and whether it passes a card's, an address's or an e-mail's check.
Weights are learnt from a small labelled table by gradient steps on the whole log-likelihood. In tasks, attributes are
computed once for each distinct word of a slice, scores are gathered for all words at once, and only stretches where
something but nothing can win are decoded, many at a time. A stretch of other labels gains at most what the best steps
among them give less what nothing leads by; words in no stretch that could gain have nothing on the best path, so the
result is that of Viterbi over the whole text. Stretches of a kind become spans if they pass a last check and meet no
span of the patterns.

Defined results: a null text is empty and has no spans; texts and words may have any length; equal texts have equal
spans; rows without an id and repeated rows stay; an empty table gives an empty table, an empty labelled table a field
that adds nothing. Only the text and the columns of ``keep`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mnesis.llm.common import coded_words, mix, slices, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
SPANS = "array<struct<kind: string, start: long, end: long, base: boolean>>"
REACH = (-2, -1, 0, 1, 2)
#: A labelled table has at most so many rows; the field is fitted in the driver.
MAX_LABELLED = 10_000
STEPS, RATE, PENALTY = 250, 0.3, 0.02
#: Attributes that fewer words of the table have count as unknown, so that single words don't stand for what is beside them.
SEEN = 3

DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBER = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_BACKWARDS = re.compile(rb"[A-Za-z0-9._%+-]+")
EMAIL = re.compile(rb"[^@\s]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(rb"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
#: A byte's class in a shape: letters x or X, digits 9, marks as they are.
CLASS = np.arange(256, dtype=np.uint64)
CLASS[48:58], CLASS[65:91], CLASS[97:123], CLASS[128:] = 57, 88, 120, 120
FOLDED = np.arange(256, dtype=np.uint64)
FOLDED[65:91] += np.uint64(32)
#: Bytes that a word's outer marks end at.
CORE = DIGIT | (CLASS == 88) | (CLASS == 120)
OPENING, CLOSING = CORE.copy(), CORE.copy()
OPENING[[ord("+"), ord("(")]] = True
CLOSING[ord(")")] = True

#: The labelled table: what stands in [kind:...] is of that kind.
EXAMPLES = """
Please call me at [phone:+1 (212) 555-0187] after lunch.
My number is [phone:(415) 555-0132] and I am home in the evening.
Reach the office on [phone:+44 20 7946 0958] or write.
Tel. [phone:020 7946 0123], ask for the desk.
phone: [phone:555-867-5309] weekdays only
Fax [phone:+49 30 901820] ist immer an.
Bitte rufen Sie [phone:030 901820 14] an, danke.
Mein Telefon ist [phone:+49 170 5550199] und bleibt so.
Appelez le [phone:+33 1 70 18 00 01] avant midi.
Mon téléphone : [phone:01 70 18 99 55], merci.
Llame al [phone:+34 910 555 018] por la tarde.
Su teléfono es [phone:910 555 018] y no cambia.
the of [phone:+1 (974) 555-3436] that and it
in re [phone:+1 (017) 555-7713] [card:4929348385146306] is on
und die [phone:+1 (243) 555-5526] [card:5555555555554444] der ein
[phone:+1 (132) 555-1352] le des [card:4012888888881881] [card:4111111111111111] en
call [phone:+1 212 555 0187] [ip:10.20.30.40] now
Write to [email:jane.doe@mail.example.com] about it.
Her address is [email:j_smith+news@example.org], not mine.
Schreiben Sie an [email:info@beispiel.example.de] bitte.
Écrivez à [email:contact@exemple.example.fr] pour cela.
Escriba a [email:ventas@tienda.example.es] hoy.
mail [email:ana at example dot com] for the list
my email is [email:bob (at) example (dot) org] thanks
contact [email:kim [at] example [dot] net] today
e-mail [email:müller@example.de] oder anrufen
and [email:the.34@mail7.example.com] [email:of.55@mail4.example.com] was
The server at [ip:192.168.17.4] did not answer.
ip [ip:10.0.0.138] was seen twice, then [ip:172.16.254.1] again.
Login from [ip:203.0.113.77] failed.
la de [ip:97.51.17.173] que [card:4532015112830366] con
an der [ip:8.8.4.4]. Das ist alles.
host [ip:2001:db8::ff00:42:8329] is up
Card number [card:4111 1111 1111 1111] was charged.
Pay with [card:5500-0000-0000-0004] or cash.
Her card [card:378282246310005] expired.
Karte [card:4012888888881881] wurde belastet.
carte [card:5105105105105100] refusée
tarjeta [card:6011111111111117], gracias
2669109448945251 [card:4929348385146306] the on
7536784127813051 [card:4845168114407329] la que
[card:4245100581169930] 9777946427004852 an of
that [card:4550997810720808] [card:4952935900253052] in re
für [card:4417744280351547] [card:4263429643439180] [card:4795522935961213] das
the [card:4080250821787625] [card:4026083977531332] was
de los [card:4699858775519183] [card:4371549438645904] con
numbers 2353820953013749 9380942693487180 are serials
und 7536784127813051 2669109448945251 zwei Nummern
the of and was that this is on by for
The order 2669109448945251 was sent to the shop.
Number 9777946427004852 is only a serial.
und 7831906410944123 die der das ist nicht
le 1219538112535716 est une référence des pièces
el 0300233469491448 es el pedido de ayer
in 1984 there were 365 days and 12 months
At 10:45 on 2021-03-14 we left room 204.
Version 2.4.1 replaced 2.3 in May.
It costs 1,299.99 dollars or 24.50 a month.
He ran 42 km in 3:25:17, at 37 years of age.
Section 3.2.1 on page 118 has the proof.
token = "5d190bd7c06284de91015a36974748794293dd8a" is set
The isbn 978-3-16-148410-0 is printed inside.
ratio 300.400.500.600 is no address
build 1.2.3.4.5 was skipped
Follow @anna and @ben on the site.
meet at noon at the dot on the map
He is at home at the moment.
Das ist ein Satz. Und noch einer, bitte!
Est-ce que tu viens ? Oui, demain.
¿Qué hora es? Son las 5 y media.
A | b | c | 12 | 34
|---|---|---|
lines 10 20 30 40 50 60 70
3 + 4 = 7 and +5 is more (see 2) than -1
f(x) = (a + b) * 2.5e10 - c[0]
zip 90210-1234, box 5512
Hello!! the%%% of### and*** is$$$ 12!!
"""


def luhn(digits: bytes) -> bool:
    values = [c - 48 for c in digits[::-1]]
    return sum(values[::2] + [2 * v - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def small_parts(parts: tuple[bytes, ...]) -> bool:
    return all(len(x.lstrip(b"0")) <= 3 and int(x.lstrip(b"0") or b"0") <= 255 for x in parts)


def base_spans(raw: bytes, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, end (bytes) and kind of the patterns' matches in texts that lie one after the other."""
    data, found = np.frombuffer(raw, np.uint8), []
    text_of = lambda at: int(np.searchsorted(bounds, at, "right")) - 1
    free = 0
    for at in np.flatnonzero(data == 64).tolist():
        text = text_of(at)
        local = LOCAL_BACKWARDS.match(raw[max(free, int(bounds[text])) : at][::-1])
        domain = DOMAIN.match(raw, at + 1, int(bounds[text + 1])) if local else None
        if domain:
            found.append((at - local.end(), domain.end(), 0))
        free = domain.end() if domain else at + 1  # no name crosses an @

    digit = DIGIT[data]
    edge = digit.copy()
    edge[1:] &= ~digit[:-1]
    edge[bounds[:-1][bounds[:-1] < len(raw)]] |= digit[bounds[:-1][bounds[:-1] < len(raw)]]
    starts = np.flatnonzero(edge)
    if len(starts):
        run = np.cumsum(edge) - 1
        ends = starts + np.bincount(run[digit], minlength=len(starts))
        between = data[np.minimum(ends[:-1], len(data) - 1)]
        near = (starts[1:] - ends[:-1] == 1) & (np.searchsorted(bounds, starts[1:], "right") == np.searchsorted(bounds, starts[:-1], "right"))
        for kind, joins in ((1, near & (between == 46)), (2, near & ((between == 32) | (between == 45)))):
            first = np.flatnonzero(np.concatenate(([True], ~joins)))
            size = np.diff(np.append(first, len(starts)))
            if kind == 1:
                for i, n in zip(first[size >= 4].tolist(), size[size >= 4].tolist(), strict=True):
                    for j in range(i, i + n - 3, 4):
                        if small_parts(tuple(raw[starts[k] : ends[k]] for k in range(j, j + 4))):
                            found.append((int(starts[j]), int(ends[j + 3]), 1))
            else:
                digits = np.add.reduceat(ends - starts, first)
                for i, n in zip(first[(digits >= 14) & (digits <= 19)].tolist(), size[(digits >= 14) & (digits <= 19)].tolist(), strict=True):
                    if luhn(b"".join(raw[starts[k] : ends[k]] for k in range(i, i + n))):
                        found.append((int(starts[i]), int(ends[i + n - 1]), 2))
    for at in np.flatnonzero((data[:-1] == 43) & digit[1:]).tolist():
        number = NUMBER.match(raw, at, int(bounds[text_of(at) + 1]))
        if number and 10 <= sum(48 <= c < 58 for c in number.group()) <= 15:
            found.append((at, number.end(), 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(max(n, 1), 0x9E3779B97F4A7C15, np.uint64))


def attributes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of non-empty words: the hashes of their attributes (shape, digits, word, check), where each word's core begins and
    ends in it, and whether it is a whole card, IP or e-mail address."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    starts, place = offsets[:-1], np.arange(len(data))
    low = np.minimum.reduceat(np.where(OPENING[data], place, len(data)), starts)
    high = np.maximum.reduceat(np.where(CLOSING[data], place, -1), starts)
    low, high = np.where(low > high, starts, low), np.where(low > high, offsets[1:] - 1, high)  # marks alone count whole
    word = np.repeat(np.arange(len(starts)), np.diff(offsets))
    inner = (place >= low[word]) & (place <= high[word])
    kind = CLASS[data]
    kept = inner & ((kind != np.roll(kind, 1)) | (place == low[word]))
    rank = np.cumsum(kept)
    rank = np.where(kept, rank - rank[low][word], 0)
    spread = powers(int(np.diff(offsets).max()) + 1)
    shape = np.add.reduceat(np.where(kept, kind * spread[rank], np.uint64(0)), starts)
    digits = np.add.reduceat(DIGIT[data] & inner, starts, dtype=np.int64)
    itself = np.add.reduceat(np.where(inner, FOLDED[data] * spread[np.where(inner, place - low[word], 0)], np.uint64(0)), starts)
    check = np.zeros(len(starts), np.uint64)
    raw, marked = data.tobytes(), np.logical_or.reduceat(data == 64, starts)
    for i in np.flatnonzero(((digits >= 4) & (digits <= 19)) | marked).tolist():
        core = raw[low[i] : high[i] + 1]
        if 13 <= len(core) == digits[i]:
            check[i] = 1 if luhn(core) else 2
        elif parts := ADDRESS.fullmatch(core):
            check[i] = 3 if small_parts(parts.groups()) else 4
        elif marked[i]:
            check[i] = 5 if EMAIL.fullmatch(core) else 6
    columns = [shape, np.digitize(digits, [1, 4, 5, 10, 14, 20]).astype(np.uint64), np.where(digits == 0, itself, np.uint64(0)), check]
    hashes = np.stack([mix(c * np.uint64(8) + np.uint64(k + 1)) for k, c in enumerate(columns)], axis=1)
    return hashes, low - starts, high + 1 - starts, np.isin(check, [1, 3, 5])


class Field:
    """known: the attributes' hashes, ascending; weights: for each place of REACH, attribute (the last: any other) and
    label; bias and steps: for each label, and for each label and its follower."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: np.ndarray, steps: np.ndarray):
        self.known, self.weights, self.bias, self.steps = known, weights, bias, steps
        among, nothing = steps[1:, 1:].max(), steps[0, 0]
        self.each, self.frame = among - nothing, steps[0, 1:].max() + steps[1:, 0].max() - among - nothing

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(hashes.shape, np.int64)
        at = np.searchsorted(self.known, hashes).clip(max=len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, len(self.known))

    def scores(self, hashes: np.ndarray, codes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        """Of each word and label; text: the text that the word is in."""
        rows = self.rows(hashes)
        place = np.arange(len(codes)) + 2 * (text + 1)  # two empty places around each text
        padded = np.full(len(codes) + 2 * (texts + 1), len(hashes), np.int64)
        padded[place] = codes
        out = np.tile(self.bias, (len(codes), 1))
        for reach, weights in zip(REACH, self.weights, strict=True):
            of_word = np.concatenate((weights[rows].sum(1), np.zeros((1, len(LABELS)))))
            out += of_word[padded[place + reach]]
        return out

    def decode(self, scores: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The best labels of all words. Only stretches where another label than nothing may win are looked at."""
        labels = np.zeros(len(scores), np.int8)
        if not len(scores):
            return labels
        # nothing's leads over a stretch of other labels, less the most that their steps gain: the sum to each word
        sums = np.cumsum(scores[:, 0] - scores[:, 1:].max(1) - self.each)
        least = np.minimum.accumulate(sums[::-1])[::-1] - np.maximum.accumulate(np.concatenate(([0.0], sums[:-1])))
        unsure = np.flatnonzero(least <= self.frame + 1e-6)
        if not len(unsure):
            return labels
        first = np.flatnonzero(np.concatenate(([True], (np.diff(unsure) > 1) | (text[unsure[1:]] != text[unsure[:-1]]))))
        size = np.diff(np.append(first, len(unsure)))
        order, lo = np.argsort(size, kind="stable"), 0
        while lo < len(order):
            hi = lo + max(1, int(np.searchsorted(size[order[lo:]], 2 * size[order[lo]], "right")))
            hi = min(hi, lo + max(1, (1 << 18) // int(size[order[hi - 1]])))
            group, longest = order[lo:hi], int(size[order[hi - 1]])
            inside = np.arange(longest) < size[group][:, None]
            words = np.where(inside, unsure[first[group]][:, None] + np.arange(longest), 0)
            part = np.where(inside[:, :, None], scores[words], np.where(np.arange(len(LABELS)) == 0, 0.0, -1e18))
            labels[words[inside]] = viterbi(part, self.steps)[inside]
            lo = hi
        return labels


def viterbi(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best labels of sequences by places and labels, with nothing before and after them; ties go to the first label."""
    n, length, _ = scores.shape
    best, back = steps[0] + scores[:, 0], np.zeros((n, length, len(steps)), np.int8)
    for t in range(1, length):
        ways = best[:, :, None] + steps
        back[:, t] = ways.argmax(1)
        best = ways.max(1) + scores[:, t]
    out = np.zeros((n, length), np.int8)
    out[:, -1] = (best + steps[:, 0]).argmax(1)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = np.take_along_axis(back[:, t], out[:, t, None].astype(np.int64), 1)[:, 0]
    return out


def marked(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The text of a line of EXAMPLES and its spans."""
    text, spans = "", []
    for part in re.split(r"(\[(?:email|ip|card|phone):(?:[^\[\]]|\[[a-z]+\])+\])", line):
        if found := re.fullmatch(r"\[(email|ip|card|phone):(.+)\]", part):
            spans.append((found[1], len(text), len(text) + len(found[2])))
            part = found[2]
        text += part
    return text, spans


def examples(spark: SparkSession) -> DataFrame:
    rows = [marked(line) for line in EXAMPLES.strip().splitlines()]
    return spark.createDataFrame(rows, "text string, spans array<struct<kind: string, start: long, end: long>>")


def with_labels(texts: list[str], spans: list[list]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and of each word its code, text and label."""
    codes, words, offsets = coded_words(pa.array(texts, pa.string()))
    text, labels = np.repeat(np.arange(len(texts)), np.diff(offsets)), []
    for line, marks in zip(texts, spans, strict=True):
        for word in re.finditer(r"[^\x20\x09-\x0D]+", line):
            labels.append(next((1 + KINDS.index(k) for k, a, b in marks if word.start() < b and a < word.end()), 0))
    return words, codes, text, np.array(labels, np.int64)


def fit(labelled: DataFrame, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Field:
    """The field of a small table of texts and their spans (kind, start, end in code points), by AdaGrad over the whole
    log-likelihood, in the driver."""
    table = labelled.select("text", "spans").limit(MAX_LABELLED + 1).collect()
    if len(table) > MAX_LABELLED:
        raise ValueError(f"a labelled table has at most {MAX_LABELLED} rows")
    table = sorted((r.text or "", sorted(map(tuple, r.spans or []))) for r in table)
    words, codes, text, labels = with_labels([t for t, _ in table], [s for _, s in table])
    none = Field(np.zeros(0, np.uint64), np.zeros((len(REACH), 1, len(LABELS))), np.array([1.0] + [0.0] * len(KINDS)), np.zeros((len(LABELS), len(LABELS))))
    if not len(codes):
        return none
    hashes = attributes(words)[0]
    attribute, times = np.unique(hashes[codes], return_counts=True)
    known = attribute[times >= SEEN]
    rows = Field(known, none.weights, none.bias, none.steps).rows(hashes)
    size = np.bincount(text, minlength=len(table))
    size = size[size > 0]
    first, longest = np.cumsum(size) - size, int(size.max())
    inside = np.arange(longest) < size[:, None]
    at = np.where(inside, first[:, None] + np.arange(longest), 0)
    pair_seen = np.zeros_like(none.steps)
    starts, last = np.diff(text, prepend=-1) > 0, np.diff(text, append=len(table)) > 0
    np.add.at(pair_seen, (np.where(starts, 0, np.roll(labels, 1)), labels), 1)
    np.add.at(pair_seen, (labels[last], 0), 1)
    field = Field(known, np.zeros((len(REACH), len(known) + 1, len(LABELS))), np.zeros(len(LABELS)), np.zeros_like(none.steps))
    params = [field.weights, field.bias, field.steps]
    seen = [np.full_like(p, 1e-8) for p in params]
    place = np.arange(len(codes)) + 2 * (text + 1)
    padded = np.full(len(codes) + 2 * (len(table) + 1), len(hashes), np.int64)
    padded[place] = codes
    rows = np.concatenate((rows, np.full((1, rows.shape[1]), len(known))))
    for _ in range(steps):
        scores = field.scores(hashes, codes, text, len(table))
        alone, pairs = marginals(np.where(inside[:, :, None], scores[at], np.where(np.arange(len(LABELS)) == 0, 0.0, -1e18)), field.steps, inside)
        lack = np.eye(len(LABELS))[labels]
        lack[at[inside]] -= alone[inside]
        grads = [np.zeros_like(field.weights), lack.sum(0), pair_seen - pairs]
        for k, reach in enumerate(REACH):
            for column in rows[padded[place + reach]].T:
                np.add.at(grads[0][k], column, lack)
        grads[0][:, -1] = 0
        for p, g, total in zip(params, grads, seen, strict=True):
            g = g - penalty * p
            total += g * g
            p += rate * g / np.sqrt(total)
    return Field(known, *params)


def marginals(scores: np.ndarray, steps: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences with nothing before and after them: each place's probabilities of labels, and how many times each
    label is expected to follow each, the frame included."""

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    n, length, labels = scores.shape
    ahead, behind = np.zeros((n, length, labels)), np.zeros((n, length, labels))
    ahead[:, 0] = steps[0] + scores[:, 0]
    for t in range(1, length):
        ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + steps, 1) + scores[:, t]
    behind[:, -1] = steps[:, 0]
    for t in range(length - 2, -1, -1):
        behind[:, t] = log_sum(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    whole = log_sum(ahead[:, -1] + steps[:, 0], 1)
    alone = np.exp(ahead + behind - whole[:, None, None])
    pairs = np.zeros_like(steps)
    pairs[0] += alone[:, 0].sum(0)
    for t in range(1, length):
        both = np.exp(ahead[:, t - 1, :, None] + steps + (scores[:, t] + behind[:, t])[:, None, :] - whole[:, None, None])
        pairs += both[inside[:, t - 1]].sum(0)  # from the last place into the frame too, which the padding stands for
    pairs[:, 0] += alone[:, -1][inside[:, -1]].sum(0)
    return alone, pairs


def whole_span(kind: int, text: bytes) -> bool:
    """The last check of a span that the field adds."""
    digits = bytes(c for c in text if 48 <= c < 58)
    if kind == 0:
        return bool(re.fullmatch(rb"\S+ ?(@|\(at\)|\[at\]|\bat\b) ?\S+( ?(\.|\bdot\b|\(dot\)|\[dot\]) ?\S+)*", text)) and bool(re.search(rb"\w(\.| dot | \(dot\) | \[dot\] )\w", text))
    if kind == 1:
        parts = ADDRESS.fullmatch(text)
        return small_parts(parts.groups()) if parts else bool(re.fullmatch(rb"[0-9A-Fa-f]{0,4}(:[0-9A-Fa-f]{0,4}){2,7}", text)) and (b"::" in text or text.count(b":") == 7) and bool(digits)
    if kind == 2:
        return bool(re.fullmatch(rb"[0-9 -]+", text)) and 13 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(rb"\+?[0-9() ./-]+", text)) and 7 <= len(digits) <= 15


def spans_in(texts: pa.Array, field: Field) -> pa.Array:
    """The spans of every text, patterns' and field's, by start, then kind; places are code points."""
    texts = pc.fill_null(texts, "")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[bounds[0] : bounds[-1]]
    bounds -= bounds[0]
    data = np.frombuffer(raw, np.uint8)
    fixed = base_spans(raw, bounds)
    added: list[tuple[int, int, int]] = []
    codes, words, offsets = coded_words(texts)
    if len(codes):
        hashes, low, high, complete = attributes(words)
        text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        labels = field.decode(field.scores(hashes, codes, text, len(texts)), text)
        at = np.flatnonzero(labels)
        if len(at):
            edge = ~SPACES[data]
            begins = bounds[:-1][bounds[:-1] < len(data)]
            first = edge[begins]
            edge[1:] &= SPACES[data[:-1]]
            edge[begins] = first
            start = np.flatnonzero(edge)
            whole = complete[codes[at]]
            split = np.concatenate(([True], (np.diff(at) > 1) | (labels[at[1:]] != labels[at[:-1]]) | (text[at[1:]] != text[at[:-1]]) | whole[1:] | whole[:-1]))
            head, tail = at[split], at[np.append(np.flatnonzero(split)[1:], len(at)) - 1]
            taken = [(a, b) for a, b, _ in fixed]
            reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
            tops = np.array([a for a, _ in taken])
            for a, b, kind in zip((start[head] + low[codes[head]]).tolist(), (start[tail] + high[codes[tail]]).tolist(), labels[head].tolist(), strict=True):
                before = int(np.searchsorted(tops, b))  # spans that begin before b
                if (not before or reach[before - 1] <= a) and whole_span(kind - 1, raw[a:b]):
                    added.append((a, b, kind - 1))
    spans = sorted([(*x, True) for x in fixed] + [(*x, False) for x in added], key=lambda x: (x[0], x[2]))
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    of = np.searchsorted(bounds, [x[0] for x in spans], "right") - 1 if spans else np.zeros(0, np.int64)
    start, end = (points[np.array([x[k] for x in spans], np.int64)] - points[bounds[of]] for k in (0, 1))
    flat = pa.StructArray.from_arrays([pa.array([KINDS[x[2]] for x in spans], pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array([x[3] for x in spans], pa.bool_())], ["kind", "start", "end", "base"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(texts))))).astype(np.int32)), flat)


def find(docs: DataFrame, field: Field, keep: list[str], name: str = "spans") -> DataFrame:
    """The columns of keep, and every text's spans as an array under ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([*part.columns[1:], spans_in(part.column("text"), field)], [*keep, name])

    kept = docs.select(text_or_empty("text").alias("text"), *[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)])
    kinds = [f"`{c}` {kind}" for c, (_, kind) in zip(keep, kept.dtypes[1:], strict=True)]
    return kept.mapInArrow(run, ", ".join([*kinds, f"`{name}` {SPANS}"]))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame, keep: list[str], name: str = "spans") -> DataFrame:
    """keep, the number of the patterns' spans of each kind, the hash of their list, and the list of all spans."""
    spans = F.col(f"`{name}`")
    base = F.filter(spans, lambda x: x["base"])
    of_kind = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS]
    return found.select(*[F.col(f"`{c}`") for c in keep], *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"))
