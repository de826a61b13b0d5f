"""Personal data and secrets: candidates by high-recall generators, judged by boosted trees, redacted above calibrated thresholds.

Generators propose every span that could be an address, number, key or the like; their spans overlap. Each is
described by its format (lengths, separators, check digits, ranges, randomness) and its context (words before it,
characters around it), and boosted trees, fitted on labelled sentences, give it log odds, which Platt's method turns
into a probability. Of overlapping spans the most probable is taken, if it reaches its kind's threshold: the largest
with which ``RECALL`` of the held-out positives is found, but at most one half.

The labelled sentences, of which ``SENTENCES`` bounds the number, are composed here by a seeded generator: real data of
this kind must not be collected to train on. They hold each kind in many formats, with and without telling words,
and look-alikes: versions, dates, prices, identifiers, checksums, long words. Card numbers have a valid check digit and
an issuer's prefix, as real ones do; other long numbers are look-alikes.
"""

from __future__ import annotations

import bisect
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodeweave.llm import boosting

KINDS = ("EMAIL", "PHONE", "IP", "CARD", "SSN", "IBAN", "SECRET")
#: Bound of the labelled sample, and what part of it is held out to calibrate with.
SENTENCES, HELD = 16000, 0.3
#: For so many sentences, one of very long secrets or look-alikes is added.
LONG = 20
RECALL = 0.995
SEED = 20240607
_CONTEXT = 32

_LINE = re.compile(r"[0-9@=:]")
#: From the start of a run of its characters to the last @ that follows it: linear, and of any length.
_LOCAL = re.compile(r"(?<![\w.+\-%])[\w.+\-%]++(?=@)")
_DOMAIN = re.compile(r"@[^\W_][\w\-]*+(?:\.[\w\-]++)++")
_PATTERNS = [
    ("PHONE", re.compile(r"(?<![\w.])(?:\+|00)\d{1,3}[ .\-]?\(?\d{1,4}\)?(?:[ .\-/]?\d{2,4}){2,4}(?!\d)")),
    ("PHONE", re.compile(r"(?<![\w.+])\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)")),
    ("PHONE", re.compile(r"(?<![\w.+])\(?0\d{1,4}\)?(?:[ .\-/]?\d{2,4}){2,4}(?!\d)")),
    ("IP", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)")),
    ("IP", re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:{1,2}){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")),
    ("CARD", re.compile(r"(?<![\w])\d{13,19}(?!\w)")),
    ("CARD", re.compile(r"(?<![\w])\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}(?!\w)")),
    ("CARD", re.compile(r"(?<![\w])3\d{3}[ \-]\d{6}[ \-]\d{5}(?!\w)")),
    ("SSN", re.compile(r"(?<![\w\-])\d{3}[\- ]\d{2}[\- ]\d{4}(?![\w\-])")),
    ("IBAN", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("SECRET", re.compile(r"(?i:passw(?:or)?d|passphrase|pwd|token|secret|credentials?|api[_\- ]?key|access[_\- ]?key|private[_\- ]?key|auth)[\w\-]{0,64}+[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"',;<>]{4,})")),
    ("SECRET", re.compile(r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}+(?:\.[A-Za-z0-9_\-]{8,}+(?![+/])){0,2}={0,2}(?![A-Za-z0-9+/_\-])")),
]
_WORDS = {
    "mail": re.compile(r"(?i)mail|contact|write|reply|@"),
    "phone": re.compile(r"(?i)phone|tel\b|call|mobile|fax|cell|telefon|whatsapp"),
    "host": re.compile(r"(?i)\bip\b|host|server|address|login|client|ping"),
    "card": re.compile(r"(?i)card|visa|master|amex|credit|debit|paid"),
    "bank": re.compile(r"(?i)iban|bank|account|konto|transfer"),
    "social": re.compile(r"(?i)ssn|social|tax"),
    "key": re.compile(r"(?i)pass|pwd|token|secret|key|auth|credential|bearer"),
    "version": re.compile(r"(?i)version|release|\bv[.\d]*\s*$|build|firmware|section|chapter|article|licen[sc]e"),
    "item": re.compile(r"(?i)isbn|order|invoice|item|serial|number|\bno\.?|#\s*$|\bid\b|page|figure|ticket|case"),
    "sum": re.compile(r"(?i)commit|sha|md5|checksum|hash|digest|revision|uuid|blob|etag"),
    "money": re.compile(r"[$€£¥]\s*$|(?i:price|usd|eur|total|cost)"),
    "link": re.compile(r"(?i)https?://\S*$|www\.\S*$|/\S*$"),
    "date": re.compile(r"(?i)\b(?:date|since|on|in|from|until|born|dated|year)\s*$"),
}
_KEYS = re.compile(r"AKIA|ASIA|gh[pousr]_|sk[-_]|xox[abp]-|eyJ|AIza|glpat-|npm_|-----")
_DATE = re.compile(r"(?:19|20)\d\d[-./ ]?\d{1,2}[-./ ]?\d{1,2}(?!\d)|\d{1,2}[-./ ]\d{1,2}[-./ ](?:19|20)?\d\d(?!\d)|(?:19|20)\d\d\s?[-–]\s?(?:19|20)\d\d")


def candidates(text: str) -> list[tuple[int, int, str]]:
    """All spans that the generators propose, once each, in order."""
    found: set[tuple[int, int, str]] = set()
    at = 0
    for line in text.split("\n"):
        if _LINE.search(line) is not None or len(line) >= 16:
            numbers = any(c in line for c in "0123456789")
            marks = "=" in line or ":" in line
            keys = _KEYS.search(line) is not None
            for k, (kind, pattern) in enumerate(_PATTERNS):
                if kind == "SECRET" and pattern.groups:
                    if marks:
                        found.update((at + m.start(1), at + m.end(1), kind) for m in pattern.finditer(line))
                elif numbers or (kind == "SECRET" and keys):
                    found.update((at + m.start(), at + m.end(), kind) for m in pattern.finditer(line))
            for left in _LOCAL.finditer(line) if "@" in line else ():
                if right := _DOMAIN.match(line, left.end()):
                    end = right.end()
                    while line[end - 1] in ".-_":
                        end -= 1
                    found.add((at + left.start(), at + end, "EMAIL"))
        at += len(line) + 1
    return sorted(found)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


#: Issuers' prefixes and the lengths of their numbers.
_ISSUED = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d{12}|3[47]\d{13}|(?:6011|64[4-9]\d|65\d\d|62\d\d)\d{12,15}|35(?:2[89]|[3-8]\d)\d{12}|3(?:0[0-5]|[68]\d)\d{11}")


def _mod97(s: str) -> bool:
    s = s.replace(" ", "")
    s = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a span."""
    s = text[start:end]
    before, after = text[max(0, start - _CONTEXT) : start].split("\n")[-1], text[end : end + 8]
    digits = "".join(c for c in s if c in string.digits)
    letters = sum(c.isalpha() for c in s)
    upper = sum(c.isupper() for c in s)
    counts = Counter(s)
    entropy = -sum(n / len(s) * math.log2(n / len(s)) for n in counts.values())
    octets = [int(x) for x in s.split(".") if x in ("0",) or x.isdigit() and x.isascii()] if kind == "IP" else []
    runs = re.findall(r"[A-Za-z]+|\d+", s)
    turns = sum((a in string.digits) != (b in string.digits) for a, b in zip(s, s[1:]))
    out = [float(kind == k) for k in KINDS]
    out += [len(s), len(digits), letters, upper / max(1, letters), entropy, turns / len(s), len(runs), max(map(len, runs), default=0)]
    out += [s.count("."), s.count("-"), s.count(" "), s.count("/"), s.count(":"), s.count("_"), float("(" in s), float(s[0] == "+"), float(s[0] == "0")]
    out += [float(len(digits) >= 12 and kind == "CARD" and _luhn(digits)), float(kind == "CARD" and _ISSUED.fullmatch(digits) is not None)]
    out += [float(len(octets) == 4 and max(octets) <= 255), float(octets[0]) if octets else -1.0]
    out += [float(kind == "IBAN" and s.isascii() and _mod97(s)), float(bool(re.fullmatch(r"[0-9a-fA-F]+", s))), float(_KEYS.match(s) is not None), float(_DATE.match(s) is not None)]
    out += [float(bool(digits) and letters > 0), float(s.islower()), float(bool(re.search(r"[aeiouyäöüéèáíó][bcdfghjklmnpqrstvwxz]{1,2}[aeiouyäöüéèáíó]", s.lower()))), float(len(digits) / len(s))]
    out += [float(p.search(before) is not None) for p in _WORDS.values()]
    out += [float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:].isalnum()), float(before[-1:] in tuple("$€£#/@&=?")), float(bool(re.match(r"\s?[%€$£°]|\s?(?:kg|km|m|cm|USD|EUR)\b", after))), float(after[:1].isalnum()), float(after[:1] in tuple("/-@:"))]
    return out


def _sentence(rnd: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A sentence, and where it holds personal data or secrets."""
    d = lambda n: "".join(rnd.choice(string.digits) for _ in range(n))
    c = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    word = lambda: "".join(rnd.choice("bcdfghklmnprstvw") + rnd.choice("aeiouéü") for _ in range(rnd.randint(1, 5)))
    pick = rnd.choice

    def luhn(n: int, first: str) -> str:
        s = first + d(n - len(first) - 1)
        return next(s + x for x in string.digits if _luhn(s + x))

    card = lambda n: luhn(n, pick(["4", "4", "4", *map(str, range(51, 56)), *map(str, range(2221, 2721, 50)), "6011", "65", "62", "3530", "3580"]))

    def unlike(n: int) -> str:
        """A long number that is no card's: a wrong check digit or no issuer's prefix."""
        s = d(n)
        return s if not _luhn(s) or not _ISSUED.fullmatch(s) else s[:-1] + str((int(s[-1]) + rnd.randint(1, 9)) % 10)

    def assigned() -> str:
        """A name, and what assigns a value to it."""
        name = pick(["", "", "my_", "app_", "db-", "X-"]) + pick(["password", "passwd", "pwd", "passphrase", "secret", "api_key", "api-key", "access_key", "auth_token", "access_token", "client_secret", "private_key", "credentials"]) + pick(["", "", "", "_1", "_prod"])
        name = pick([name, name, name.upper(), name.capitalize()])
        return pick(["", "", "", '"', "export "]) + name + pick(["=", ": ", " : ", ":", ' = "', '="', "='", ": '", '": "'])

    def iban() -> str:
        body, land = d(rnd.choice([14, 16, 18, 20])), pick(["DE", "FR", "ES", "GB", "IT", "NL"])
        if land == "GB":
            body = c(string.ascii_uppercase, 4) + body
        check = 98 - int("".join(str(int(x, 36)) for x in body + land + "00")) % 97
        s = f"{land}{check:02d}{body}"
        return pick([s, " ".join(s[k : k + 4] for k in range(0, len(s), 4))])

    octets = lambda: ".".join(str(rnd.randint(0 if k else 1, 255)) for k in range(4))
    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    positive = {
        "EMAIL": lambda: (pick(["", "", "mail ", "contact: ", "write to "]), pick([f"{word()}.{word()}", word(), f"{word()}{d(2)}", f"{word()}-{word()}", f"{d(3)}{word()}", f"{word()}_{word()}+{word()}", f"{c(string.ascii_uppercase, 5)}"]) + "@" + pick([f"{word()}.com", f"{word()}{d(2)}.{word()}.net", f"{word()}.{word()}.{word()}.edu", f"{word()}-{word()}.org", f"{word()}.co.uk", f"{word()}.de"])),
        "PHONE": lambda: (pick(["", "", "", "call ", "phone: ", "tel. ", "fax ", "mobile "]), pick([f"+{d(2)} ({d(2)}) {d(4)} {d(4)}", f"+{d(2)} ({d(3)}) {d(6)}", f"+1 {d(3)} {d(3)} {d(4)}", f"+1.{d(3)}.{d(3)}.{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"+49 {d(3)} {d(7)}"[:17], f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"+1-{d(3)}-{d(3)}-{d(4)}", f"{pick('23456789')}{d(2)}-{d(3)}-{d(4)}", f"+44 20 {d(4)} {d(4)}", f"0{pick('123456789')}{d(2)} {d(3)} {d(4)}", f"0{pick('123456789')} {d(2)} {d(2)} {d(2)} {d(2)}", f"{pick('23456789')}{d(2)}.{d(3)}.{d(4)}", f"+{d(2)}{d(9)}", f"0{d(2)} {d(7)}", f"0{d(3)}/{d(6)}"])),
        "IP": lambda: (pick(["", "", "", "from ", "host ", "ip "]), octets() if rnd.random() < 0.85 else ":".join(c(hexes, rnd.randint(1, 4)) for _ in range(8))),
        "CARD": lambda: (pick(["", "", "", "card ", "visa "]), pick([lambda: card(16), lambda: card(16), lambda: " ".join((x := card(16))[k : k + 4] for k in (0, 4, 8, 12)), lambda: "-".join((x := card(16))[k : k + 4] for k in (0, 4, 8, 12)), lambda: luhn(15, pick(["34", "37"])), lambda: f"{(x := luhn(15, pick(['34', '37'])))[:4]} {x[4:10]} {x[10:]}", lambda: luhn(19, "6")])()),
        "SSN": lambda: (pick(["", "", "ssn ", "social security "]), f"{rnd.randint(1, 899):03d}-{rnd.randint(1, 99):02d}-{rnd.randint(1, 9999):04d}"),
        "IBAN": lambda: (pick(["", "", "iban ", "account "]), iban()),
        "SECRET": lambda: pick([
            lambda: (assigned(), pick([c(hexes, rnd.randint(8, 24)), c(alnum + "!#%&*+", rnd.randint(8, 20)), word() + d(rnd.randint(2, 4)), word().capitalize() + d(2) + "!"])),
            lambda: (assigned(), pick([c(hexes, pick([20, 24, 32, 36, 48, 56, 64])), c(alnum, rnd.randint(16, 48)), c(alnum + "_-", rnd.randint(20, 80))])),
            lambda: (pick(["", "", "", "key "]), "AKIA" + c(string.ascii_uppercase + string.digits, 16)),
            lambda: (pick(["", ""]), pick(["ghp_" + c(alnum, 36), "sk-" + c(alnum, 40), "xoxb-" + d(11) + "-" + c(alnum, 24), "AIza" + c(alnum + "_-", 35), "glpat-" + c(alnum, 20)])),
            lambda: (pick(["", "Bearer "]), "eyJ" + c(alnum, 30) + "." + "eyJ" + c(alnum, 60) + "." + c(alnum + "_-", 43)),
            lambda: (pick(["", "secret ", "key "]), c(alnum + "+/", 40)),
        ])(),
    }
    negative = [
        lambda: f"{pick(['version', 'release', 'v', 'firmware', 'build'])} {rnd.randint(0, 20)}.{rnd.randint(0, 30)}.{rnd.randint(0, 30)}.{rnd.randint(0, 400)}",
        lambda: f"{rnd.randint(1950, 2030)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}" + pick(["", f" {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}", f"T{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00Z"]),
        lambda: f"{rnd.randint(1, 28):02d}{pick('./-')}{rnd.randint(1, 12):02d}{pick('./-')}{rnd.randint(1950, 2030)}",
        lambda: f"{pick('$€£')}{rnd.randint(1, 999)},{d(3)},{d(3)}.{d(2)}",
        lambda: f"{rnd.randint(1, 999)}.{d(3)}.{d(3)},{d(2)} {pick(['€', 'EUR'])}",
        lambda: f"{pick(['ISBN', 'isbn'])} 978-{d(1)}-{d(2)}-{d(6)}-{d(1)}" if rnd.random() < 0.5 else f"ISBN 978{d(10)}",
        lambda: f"{pick(['order', 'invoice', 'ticket', 'serial no.', 'item', 'case', 'id'])} {pick(['', '#'])}{d(rnd.randint(6, 14))}",
        lambda: f"{rnd.randint(1900, 2030)}-{rnd.randint(1900, 2030)}",
        lambda: f"{pick(['commit', 'sha256', 'checksum', 'revision', 'md5:', 'blob'])} {c(hexes, pick([32, 40, 64]))}",
        lambda: f"{pick(['uuid', 'id', ''])} {c(hexes, 8)}-{c(hexes, 4)}-{c(hexes, 4)}-{c(hexes, 4)}-{c(hexes, 12)}",
        lambda: f"https://{word()}.com/{word()}/{word()}-{word()}-{word()}/{d(rnd.randint(1, 8))}",
        lambda: "".join(word() for _ in range(rnd.randint(3, 9))) + pick(["", "-" + word() + "-" + word(), d(1), "." + d(1)]),
        lambda: f"{rnd.randint(0, 9)}.{d(rnd.randint(8, 15))}",
        lambda: unlike(pick([13, 14, 15, 16, 16, 16, 17, 18, 19, 20])),
        lambda: pick([unlike(16), luhn(16, pick(["0", "1", "7", "8", "9", "20", "28", "50", "59", "34", "66"]))]),
        lambda: d(rnd.randint(11, 12)),
        lambda: f"{rnd.randint(1, 9)} {d(3)} {d(3)} {d(3)}",
        lambda: f"{rnd.randint(1, 9)},{d(3)},{d(3)},{d(3)}",
        lambda: f"{rnd.randint(-90, 90)}.{d(4)}, {rnd.randint(-180, 180)}.{d(4)}",
        lambda: f"{pick(['password', 'token', 'secret', 'Password', 'api key', 'auth'])}: {pick(['the', 'required', 'optional', 'should', 'never', 'unit', 'see', 'reset', 'must', word()])} {word()}",
        lambda: f"{pick(['token', 'key', 'secret'])} = {pick(['None', 'null', 'true', 'false', 'value', 'string', 'config.token', 'get_token()'])}",
        lambda: f"{pick(['section', 'chapter', 'page', 'figure', 'article'])} {rnd.randint(1, 20)}.{rnd.randint(1, 20)}.{rnd.randint(1, 20)}.{rnd.randint(1, 20)}",
        lambda: f"{rnd.randint(0, 23)}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}",
        lambda: f"{rnd.randint(0, 999)} {rnd.randint(0, 999)} {rnd.randint(0, 9999)}",
        lambda: f"{rnd.randint(100, 999)}-{rnd.randint(100, 999)} {pick(['points', 'votes', 'km'])}",
        lambda: f"{word()}_{word()}_{word()}{d(1)}_{word()}",
        lambda: f"{pick(['CC BY-NC 4.0', 'Apache License, Version 2.0', 'General Public License, version 3', 'MP3', 'A4', 'H2O'])}",
        lambda: pick(["aaaaaaaaaaaaaaaaaaaaaaaa1", "----------------1", "0000000000000000", "xxxx-xxxx-1234-xxxx"]),
        lambda: "-".join(word() for _ in range(rnd.randint(4, 7))) + pick(["", f"-{d(4)}"]),
    ]
    text, truth = " ".join(word() for _ in range(rnd.randint(0, 8))), []

    def add(s: str) -> None:
        nonlocal text
        text += " " * bool(text) + s

    def item(kind: str) -> None:
        nonlocal text
        lead, s = positive[kind]()
        add(lead)
        truth.append((len(text), len(text) + len(s), kind))
        text += s + (lead[-1] if lead[-1:] in ("'", '"') else "")

    def neighbour() -> None:
        if rnd.random() < 0.15:
            pick([lambda: add(pick([d(2), d(4), d(3) + ",", word() + ":"])), lambda: (add(""), item(pick(["IP", "PHONE", "CARD", "EMAIL"])))])()

    neighbour()
    if rnd.random() < 0.5:
        add(pick(negative)())
    else:
        add("")
        item(pick(list(positive)))
    if rnd.random() < 0.4:
        text += pick([".", ",", ")", ":", "###", "!!"][: 4 if truth and truth[-1][1] == len(text) and truth[-1][2] == "SECRET" else 6])
    neighbour()
    add(" ".join(word() for _ in range(rnd.randint(0, 6))))
    return text, truth


def _long_sentence(rnd: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A sentence with a secret of hundreds or thousands of characters, or with a look-alike of that length."""
    pick, alnum = rnd.choice, string.ascii_letters + string.digits
    c = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    word = lambda: "".join(rnd.choice("bcdfghklmnprstvw") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 5)))
    size = lambda: int(math.exp(rnd.uniform(math.log(200), math.log(8000))))
    before, after = (" ".join(word() for _ in range(rnd.randint(0, 6))) for _ in range(2))
    if rnd.random() < 0.5:
        lead, s = pick([
            lambda: (pick(["", "Bearer ", "token="]), f"eyJ{c(alnum, rnd.randint(17, 80))}.eyJ{c(alnum + '_-', size())}.{c(alnum + '_-', pick([43, 86, 342]))}"),
            lambda: (pick(["token=", "token: ", "password=", "secret=", "api_key = ", "key ", "secret "]), c(alnum + pick(["", "+/"]), size()) + pick(["", "", "="])),
        ])()
    else:
        lead, s = "", pick([lambda: pick(["a", "0", "1", "-1", "ab1", "/x1"]) * size(), lambda: pick("/-_").join(word() + pick(["", "", "1", "23"]) for _ in range(size() // 6))])()
    text = f"{before} {lead}".lstrip()
    return f"{text}{s} {after}", [(len(text), len(text) + len(s), "SECRET")] if lead or s.startswith("eyJ") else []


@dataclass
class Detector:
    """The fitted trees, the calibration, and each kind's threshold."""

    trees: boosting.Trees
    scale: tuple[float, float]
    threshold: dict[str, float]

    def judge(self, x: np.ndarray) -> np.ndarray:
        """The probability of spans, by their features."""
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.trees.score(x) + b, -50, 50)))

    def found(self, text: str) -> list[tuple[int, int, str, float]]:
        """Spans of a text to redact, apart from each other, in order."""
        spans = candidates(text)
        return self.chosen(spans, self.judge(np.array([features(text, *s) for s in spans])).tolist()) if spans else []

    def chosen(self, spans: list[tuple[int, int, str]], p: list[float]) -> list[tuple[int, int, str, float]]:
        """Of overlapping spans the most probable, then the longest, then the first; a later one only apart from all those taken."""
        good = sorted((-q, s - e, s, e, k) for (s, e, k), q in zip(spans, p) if q >= self.threshold[k])
        starts: list[int] = []
        out: list[tuple[int, int, str, float]] = []
        for q, _, s, e, k in good:
            at = bisect.bisect_left(starts, s)
            if (at and out[at - 1][1] > s) or (at < len(out) and out[at][0] < e):
                continue
            starts.insert(at, s)
            out.insert(at, (s, e, k, -q))
        return out


def labelled(sentences: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Features, labels and kinds of the candidates of composed sentences."""
    rnd = random.Random(seed)
    x, y, kinds = [], [], []
    for i in range(sentences + sentences // LONG):
        text, truth = _sentence(rnd) if i < sentences else _long_sentence(rnd)
        for s, e, k in candidates(text):
            x.append(features(text, s, e, k))
            y.append(float(any(k == t and min(e, b) - max(s, a) >= 0.9 * (max(e, b) - min(s, a)) for a, b, t in truth)))
            kinds.append(k)
    return np.array(x), np.array(y), kinds


_FITTED: dict[tuple[int, int], Detector] = {}


def fit(sentences: int = SENTENCES, seed: int = SEED) -> Detector:
    """Fit, calibrate on held-out sentences, and set thresholds."""
    if (sentences, seed) in _FITTED:
        return _FITTED[sentences, seed]
    x, y, _ = labelled(int(sentences * (1 - HELD)), seed)
    trees = boosting.fit(x, y)
    x, y, kinds = labelled(int(sentences * HELD), seed + 1)
    model = Detector(trees, boosting.calibration(trees.score(x), y), {})
    p = model.judge(x)
    for k in KINDS:
        own = p[(y > 0) & (np.array(kinds) == k)]
        model.threshold[k] = float(min(0.5, np.quantile(own, 1 - RECALL))) if len(own) else 0.5
    return _FITTED.setdefault((sentences, seed), model)


def _redacted(model: Detector, column: int, names: list[str]):
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("probability", T.DoubleType())]))
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("probability", pa.float64())]))

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts: list[str | None] = part.column(column).to_pylist()
                spans = [None if t is None else candidates(t) for t in texts]
                rows = [(i, s) for i, own in enumerate(spans) for s in own or ()]
                p = []
                for j in range(0, len(rows), 4096):
                    p.extend(model.judge(np.array([features(texts[i], *s) for i, s in rows[j : j + 4096]])).tolist())
                out, at, found = [], 0, []
                for t, own in zip(texts, spans):
                    if not own:
                        out.append(t)
                        found.append(None if t is None else [])
                        continue
                    chosen = model.chosen(own, p[at : at + len(own)])
                    at += len(own)
                    pieces, last = [], 0
                    for s, e, kind, _ in chosen:
                        pieces += [t[last:s], f"[{kind}]"]
                        last = e
                    out.append("".join(pieces) + t[last:])
                    found.append([{"start": s, "end": e, "kind": kind, "probability": q} for s, e, kind, q in chosen])
                columns = [pa.array(out, pa.string()) if k == column else c for k, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, arrow), pa.array([None if x is None else len(x) for x in found], pa.int32())], names=names)

    return f, spans_type


def redact(docs: DataFrame, model: Detector | None = None) -> DataFrame:
    """Replaces personal data and secrets in text by [KIND]; adds redactions, an array of (start, end, kind, probability), and n_redactions.

    start and end are places in the original text, in code points. A null text has nulls, one without any finds is
    unchanged, with an empty array. Texts of any length are searched whole, and addresses and secrets may have any length. Of
    spans that are equal in probability the longest and then the first is taken. Input columns of the added names are
    replaced; others pass through. Rows aren't joined or compared, so repeated rows each get the same. An empty table
    gives an empty table.
    """
    docs = docs.drop("redactions", "n_redactions")
    f, kind = _redacted(model or fit(), docs.columns.index("text"), [*docs.columns, "redactions", "n_redactions"])
    return docs.mapInArrow(f, T.StructType([*docs.schema.fields, T.StructField("redactions", kind), T.StructField("n_redactions", T.IntegerType())]))
