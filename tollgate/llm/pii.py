"""Personal data replaced by surrogates of the same type.

Detected: e-mail addresses, phone, card, social-security and bank account numbers, IPv4 and IPv6 addresses, and names
after a title. What is replaced is a unit: an address, a number's digits, or one word of a name. All units of the corpus
form one table, so a unit has one surrogate wherever and however it is written (coreference), and the table is checked for
equal surrogates (distinctness).

* Numbers and addresses go through a keyed permutation of their own format (Feistel rounds on digits, hex digits or
  letters), used as encrypt, add n, decrypt: a bijection without fixed points, so distinct values stay distinct and none
  stays itself. Digits of any script are the same number as ASCII ones, and are written back in their script. Layout, country code, network and validity of check digits are kept.
* Words of names are drawn by a keyed hash, of the same script and of the title's gender.
* Where two units draw the same surrogate, or one that is a unit of the corpus itself, the losers draw again (numbers add one
  more and so walk on in their cycle) until no clash is left; each round is a join. Only where the corpus holds more than
  half of all values of a format can surrogates be among the originals: there the bijection alone decides.

Not detected: names without a title, and phone numbers without country code, brackets, dots or hyphens (`212 555 0187`),
which nothing tells from other words and numbers.

Null texts stay null. Texts without personal data pass unchanged and unmoved; of texts that may hold some, those that do
are shuffled, to meet their units' surrogates. Repeated rows are rewritten alike. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
import sys
from bisect import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_rows, stored

MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "г-н", "господин")
FEMALE = ("Mrs", "Ms", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")
NEUTRAL = ("Dr", "Prof")
TITLES = {t: g for g, titles in (("m", MALE), ("f", FEMALE), ("n", NEUTRAL)) for t in titles}
WORD = r"[^\W\d_a-zа-яà-öø-ÿ][^\W\d_]+"

#: In order of precedence where spans overlap.
PATTERNS = {
    "email": re.compile(r"[\w%+-]+(?:\.[\w%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ipv6": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "ipv4": re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "phone": re.compile(
        r"\+(?P<country>\d{1,3})[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
        r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
    ),
    "card": re.compile(r"(?<![\d.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\d-])"),
    "name": re.compile(rf"\b({'|'.join(sorted(TITLES, key=len, reverse=True))})\.? ({WORD}(?:[ -]{WORD}){{0,2}})|([一-鿿]{{2,3}})(先生|女士)"),
}
#: Digits of all scripts, as `\d` has them, with their values.
ASCII = {c: int(chr(c)) for c in range(sys.maxunicode + 1) if chr(c).isdecimal()}
TO_ASCII = {c: str(value) for c, value in ASCII.items()}
OTHER_DIGIT = re.compile(r"[^\D0-9]")
WIDE_DIGITS = "".join(rf"\x{{{c:x}}}-\x{{{c + 9:x}}}" for c, value in ASCII.items() if value == 0 and c > 0x7F)
#: What every text with personal data contains; a net for the JVM. It tries one class at each character, of the signs such data
#: begins with; digits beyond ASCII, listed as a JVM may know fewer, start at \u0660.
MAYBE = (
    "(?=[@0-9" + "".join(sorted({t[0] for t in TITLES})) + r"\x{660}-\x{10ffff}])(?:[@0-9" + WIDE_DIGITS + "]|先生|女士|"
    + "|".join(rf"{t}\.? " for t in TITLES) + ")"
)

UNIT = "struct<kind:string,value:string>"

LETTERS, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
ROUNDS = 8


class Span:
    """A stretch of text and its units; `render` writes it with their surrogates."""

    def __init__(self, kind: str, match: re.Match, text: str):
        self.kind, self.start, self.end = kind, match.start(), match.end()
        self.text = text[self.start : self.end]  # the match has ASCII digits
        if kind == "name":
            self.words = split_name(match)
            self.units = [(kind, value) for _, _, value in self.words]
        else:
            self.units = [(kind, canonical(kind, match))]

    def render(self, surrogate: dict[tuple[str, str], str]) -> str:
        if self.kind == "name":
            out, at = [], self.start
            for start, end, value in self.words:
                word = self.text[start - self.start : end - self.start]
                new = surrogate["name", value]
                out += [self.text[at - self.start : start - self.start], new.upper() if word.isupper() and len(word) > 1 else new]
                at = end
            return "".join(out) + self.text[at - self.start :]
        new = surrogate[self.units[0]]
        if self.kind == "email":
            new = new.upper() if self.text.isupper() else new
            digits = iter([c for c in self.text if c.isdecimal()])
            return "".join(in_script(c, next(digits)) if c.isdecimal() else c for c in new)
        return lay_out(self.text, new, self.kind)


def split_name(match: re.Match) -> list[tuple[int, int, str]]:
    """(start, end, value) of the words of a name; the value holds place, gender, script and the word."""
    title, words, group = (match[1], match[2], 2) if match[1] else (match[4], match[3], 3)
    gender = {"先生": "m", "女士": "f"}.get(title) or TITLES[title]
    parts = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^ -]+", words)]
    found = []
    for place, (start, end, word) in enumerate(parts):
        role = "given-" + gender if place < len(parts) - 1 else "family"
        found.append((match.start(group) + start, match.start(group) + end, f"{role}:{script_of(word)}:{word.lower()}"))
    return found


def canonical(kind: str, match: re.Match) -> str:
    """The value without its layout."""
    if kind == "email":
        return match[0].lower()
    if kind == "phone":
        digits = re.sub(r"\D", "", match[0])
        return digits[len(match["country"] or "") :]
    if kind == "ipv4":
        return ".".join(str(int(p)) for p in match[0].split("."))
    if kind == "ipv6":
        return ":".join(p.lower().zfill(4) for p in match[0].split(":"))
    return re.sub(r"[ -]", "", match[0])


def in_script(new: str, old: str) -> str:
    """A new character, as a digit in the script of the old one."""
    if not (old.isdecimal() and new.isdecimal()):
        return new
    return chr(ord(old) - ASCII[ord(old)] + int(new))


def lay_out(text: str, value: str, kind: str) -> str:
    """The surrogate in the original's layout and digits, filled in from the right so that a country code stays."""
    if kind == "ipv4":
        parts = zip(value.split("."), text.split("."), strict=True)
        return ".".join("".join(in_script(c, old[0]) for c in new) for new, old in parts)
    if kind == "ipv6":
        digit = next((c for c in text if c.isdecimal()), "0")
        return "".join(in_script(c, digit) for c in (value.upper() if text.isupper() else value))
    left, out = list(value), []
    for c in reversed(text):
        out.append(in_script(left.pop(), c) if c.isalnum() and left else c)
    return "".join(reversed(out))


def find(text: str) -> list[Span]:
    """Spans from left to right, none overlapping. Digits of other scripts are read as ASCII ones."""
    taken: list[Span] = []
    starts: list[int] = []
    original, text = text, text.translate(TO_ASCII) if OTHER_DIGIT.search(text) else text
    for kind, pattern in PATTERNS.items():
        if (kind == "email" and "@" not in text) or (kind == "ipv6" and ":" not in text):
            continue
        fresh = []
        for match in pattern.finditer(text):
            after = bisect(starts, match.start())
            if not (after and taken[after - 1].end > match.start()) and not (after < len(starts) and starts[after] < match.end()):
                fresh.append(Span(kind, match, original))
        if fresh:
            taken = sorted(taken + fresh, key=lambda s: s.start)
            starts = [s.start for s in taken]
    return taken


def number(key: bytes, *parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode(), key=key, digest_size=16).digest(), "big")


def permute(word: str, alphabet: str, key: bytes, tweak: str, steps: int = 1) -> str:
    """A keyed bijection of the words of one length over an alphabet: `steps` places on in one cycle of them all."""
    size, half = len(alphabet), len(word) // 2
    if not word:
        return word
    low, high = size**half, size ** (len(word) - half)
    value = 0
    for c in word:
        value = value * size + alphabet.index(c)
    left, right = divmod(value, high)
    label = f"{tweak}|{len(word)}"
    for turn in range(ROUNDS):
        left = (left + number(key, label, str(turn), "l", str(right))) % low
        right = (right + number(key, label, str(turn), "r", str(left))) % high
    left, right = divmod((left * high + right + steps) % (low * high), high)
    for turn in reversed(range(ROUNDS)):
        right = (right - number(key, label, str(turn), "r", str(left))) % high
        left = (left - number(key, label, str(turn), "l", str(right))) % low
    value, out = left * high + right, []
    for _ in word:
        value, digit = divmod(value, size)
        out.append(alphabet[digit])
    return "".join(reversed(out))


def permute_runs(text: str, key: bytes, tweak: str, steps: int = 1) -> str:
    """Letters among letters and digits among digits; other characters stay."""
    letters = permute("".join(c for c in text if c in LETTERS), LETTERS, key, f"{tweak}|{shape(text)}|a", steps)
    digits = permute("".join(c for c in text if c in DIGITS), DIGITS, key, f"{tweak}|{shape(text)}|d", steps)
    a, d = iter(letters), iter(digits)
    return "".join(next(a) if c in LETTERS else next(d) if c in DIGITS else c for c in text)


def shape(text: str) -> str:
    return "".join("a" if c in LETTERS else "d" if c in DIGITS else c for c in text)


def luhn(payload: str) -> int:
    doubled = [int(c) * (2 if i % 2 == 0 else 1) for i, c in enumerate(reversed(payload))]
    return -sum(d - 9 if d > 9 else d for d in doubled) % 10


def propose(kind: str, value: str, key: bytes, attempt: int) -> str:
    """Surrogate of a unit at an attempt, from 0."""
    steps = attempt + 1
    if kind == "name":
        role, script, _ = value.split(":", 2)
        return draw_name(role, script, number(key, kind, value, str(attempt)), attempt)
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        host, top = domain.rsplit(".", 1)
        return f"{permute_runs(local, key, 'local|' + domain, steps)}@{permute_runs(host, key, 'host')}.example.{top}"
    if kind == "ipv4":
        net, *rest = (int(p) for p in value.split("."))
        low = int(permute(f"{rest[0] << 16 | rest[1] << 8 | rest[2]:06x}", HEX, key, f"ipv4|{net}", steps), 16)
        return f"{net}.{low >> 16}.{low >> 8 & 255}.{low & 255}"
    if kind == "ipv6":
        net, rest = value.split(":", 1)
        new = permute(rest.replace(":", ""), HEX, key, "ipv6|" + net, steps)
        return ":".join(f"{int(group, 16):x}" for group in [net, *(new[i : i + 4] for i in range(0, len(new), 4))])
    if kind == "card":
        payload, check = value[:-1], int(value[-1])
        new = permute(payload, DIGITS, key, kind, steps)
        return new + str((luhn(new) + check - luhn(payload)) % 10)
    if kind == "iban":
        rest = "".join(c for c in value[4:] if c in DIGITS)
        digits = iter(permute(rest, DIGITS, key, f"iban|{value[:2]}|{shape(value[4:].lower())}", steps))
        account = "".join(next(digits) if c in DIGITS else c for c in value[4:])
        shift = (mod97(value) - 1) % 97  # 0 where the original's check digits are right
        check = (98 - mod97(value[:2] + "00" + account) + shift) % 97
        return f"{value[:2]}{check if check > 1 else check + 97:02d}{account}"
    return permute(value, DIGITS, key, kind, steps)


def domain(kind: str, value: str) -> tuple[str, float]:
    """The set a unit's surrogates are from, and its size. The sets of a kind don't overlap."""
    if kind == "email":
        local, place = value.rsplit("@", 1)
        return f"{kind}|{shape(local)}|{place}", float(max(26 ** sum(c in LETTERS for c in local), 10 ** sum(c in DIGITS for c in local)))
    if kind == "ipv4":
        return f"{kind}|{value.partition('.')[0]}", float(1 << 24)
    if kind == "ipv6":
        return f"{kind}|{value.partition(':')[0]}", float(1 << 112)
    if kind == "card":
        return f"{kind}|{len(value)}|{(int(value[-1]) - luhn(value[:-1])) % 10}", 10.0 ** (len(value) - 1)
    if kind == "iban":
        form = shape(value[4:].lower())
        return f"{kind}|{value[:2]}|{''.join(c for c in value[4:] if c not in DIGITS)}|{form}|{mod97(value)}", 10.0 ** form.count("d")
    return f"{kind}|{len(value)}", 10.0 ** len(value) if kind != "name" else float("inf")


def plain(kind: str, surrogate: str) -> str:
    """A surrogate as the units are written; a name's word without place, gender and script."""
    if kind == "ipv6":
        return ":".join(p.zfill(4) for p in surrogate.split(":"))
    return surrogate.lower() if kind == "name" else surrogate


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


#: First and last letters of scripts without syllables of their own here.
RANGES = {"han": (0x4E00, 0x6FFF), "kana": (0x3041, 0x3093), "hangul": (0xAC00, 0xD7A3), "arabic": (0x0627, 0x063A), "hebrew": (0x05D0, 0x05EA)}
#: Onsets, vowels, and endings of male, female, other given names and of family names.
SYLLABLES = {
    "latin": ("b d f g l m n r s t v k".split(), "a e i o u".split(), {"m": "n s r k".split(), "f": ["a"], "n": ["e"], "family": "nd rt lm ck".split()}),
    "cyrillic": ("б в г д л м н р с т к".split(), "а е и о у".split(), {"m": "н р м к".split(), "f": ["а"], "n": ["е"], "family": "енко ский ман".split()}),
    "greek": ("β γ δ κ λ μ ν ρ σ τ".split(), "α ε ι ο".split(), {"m": ["ος", "ης"], "f": ["α"], "n": ["ι"], "family": "ίδης άκης".split()}),
}


def script_of(word: str) -> str:
    point = ord(word[0])
    if 0x400 <= point < 0x530:
        return "cyrillic"
    if 0x370 <= point < 0x400:
        return "greek"
    blocks = {"han": (0x4E00, 0x9FFF), "kana": (0x3040, 0x30FF), "hangul": (0xAC00, 0xD7A3), "arabic": (0x600, 0x6FF), "hebrew": (0x590, 0x5FF)}
    return next((name for name, (a, b) in blocks.items() if a <= point <= b), "latin")


def draw_name(role: str, script: str, seed: int, attempt: int) -> str:
    """A name from a seed; later attempts are longer, so there is always one that is free."""
    if script in RANGES:
        low, high = RANGES[script]
        out = ""
        for _ in range(2 + attempt // 2):
            seed, at = divmod(seed, high - low + 1)
            out += chr(low + at)
        return out
    onsets, vowels, endings = SYLLABLES[script]
    out = ""
    for _ in range(2 + attempt // 2):
        seed, a = divmod(seed, len(onsets))
        seed, b = divmod(seed, len(vowels))
        out += onsets[a] + vowels[b]
    ends = endings[role.rpartition("-")[2]]
    return (out + onsets[seed % len(onsets)] + (ends[seed // 16 % len(ends)] if role != "family" else vowels[seed // 256 % len(vowels)] + ends[seed // 16 % len(ends)])).capitalize()


def detect(text_at: int):
    """Rows with the hash that stands before them and their units behind them."""

    def run(rows):
        for text_hash, *row in rows:
            units = sorted({u for span in find(row[text_at]) for u in span.units})
            yield text_hash, *row, [{"kind": k, "value": v} for k, v in units]

    return run


def assign(units: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) for a table of distinct units; surrogates of a kind are distinct."""
    word = F.when(F.col("kind") == "name", F.lower(F.element_at(F.split("value", ":", 3), 3))).otherwise(F.col("value"))
    originals = stored(units.select("kind", word.alias("taken")).distinct(), "originals")
    done, left, attempt = None, units, 0
    while True:
        drawn = stored(map_rows(left, proposer(key, attempt), "kind string, value string, surrogate string, plain string, domain string, half double"), "drawn")
        if done is None:
            full = drawn.groupBy("domain").agg(F.count("*").alias("n"), F.first("half").alias("half")).filter("n > half").select("domain")
            done = stored(drawn.join(full, "domain").select("kind", "value", "surrogate"), "surrogates")
            drawn = drawn.join(full, "domain", "left_anti")
        free = drawn.join(originals, (drawn["kind"] == originals["kind"]) & (drawn["plain"] == originals["taken"]), "left_anti")
        free = free.join(done, (free["kind"] == done["kind"]) & (free["surrogate"] == done["surrogate"]), "left_anti")
        winners = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate")
        done = stored(done.unionByName(winners), "surrogates")
        left = stored(drawn.join(done, ["kind", "value"], "left_anti").select("kind", "value"), "clashes")
        if left.isEmpty():
            return done
        attempt += 1


def proposer(key: bytes, attempt: int):
    def run(rows):
        for kind, value in rows:
            new = propose(kind, value, key, attempt)
            own, size = domain(kind, value)
            yield kind, value, new, plain(kind, new), own, size / 2

    return run


def replace(docs: DataFrame, key: bytes, text: str = "text", doc_id: str = "doc_id", count: str | None = None) -> DataFrame:
    """The rows with personal data in `text` replaced; other columns stay. `count` names an added column of spans.

    The net runs twice over all texts: for the rows that may hold personal data, which are read and kept with what was found in
    them, and for the others, which are passed on.
    """
    maybe: Column = F.coalesce(F.col(text).rlike(MAYBE), F.lit(False))
    names = [f"c{i}" for i in range(len(docs.columns))]  # docs may have columns of any name
    own = {f.name: f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True)}
    row, text_at, id_name = ", ".join(own.values()), docs.columns.index(text), names[docs.columns.index(doc_id)]
    read = map_rows(docs.filter(maybe).select(F.xxhash64(text), *docs.columns), detect(text_at), f"text_hash long, {row}, units array<{UNIT}>")
    some = stored(read, "may-hold-personal-data")
    surrogates = assign(some.select(F.explode("units").alias("u")).select("u.kind", "u.value").distinct(), key)
    # repeated rows have equal units: once is enough
    uses = some.select(F.col(id_name).alias("own_id"), F.col("text_hash").alias("own_hash"), F.explode("units").alias("u")).select("own_id", "own_hash", "u.*").distinct()
    mapped = uses.join(surrogates, ["kind", "value"]).groupBy("own_id", "own_hash").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("mapping"))
    holding = some.filter(F.size("units") > 0).drop("units")
    joined = holding.join(mapped, F.col(id_name).eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
    new = map_rows(joined.select(*names, "mapping"), rewrite(text_at), f"{row}, spans long")
    zero = F.lit(0).cast("long")
    clean = some.filter(F.size("units") == 0).select(*names, zero).union(docs.filter(~maybe).select(*docs.columns, zero))
    result = new.union(clean).toDF(*names, "spans")
    renamed = [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]
    return result.select(*renamed, *([F.col("spans").alias(count)] if count else []))


def rewrite(text_at: int):
    """Rows with their text's spans rendered by the mapping that stands behind them, and the number of spans."""

    def run(rows):
        for *row, mapping in rows:
            surrogates = {(m["kind"], m["value"]): m["surrogate"] for m in mapping}
            text, out, at = row[text_at], [], 0
            spans = find(text)
            for span in spans:
                out += [text[at : span.start], span.render(surrogates)]
                at = span.end
            row[text_at] = "".join(out) + text[at:]
            yield *row, len(spans)

    return run
