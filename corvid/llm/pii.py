"""PII: detected entities are replaced by keyed surrogates of the same type.

Detection (per text, in tasks): e-mail addresses, phone numbers, IPv4 addresses,
card numbers, access keys, assigned secrets, and personal names that a title or
a known given name marks. Names are replaced part by part, so that "Anna Berger"
and "Frau Berger" stay the same person.

Surrogates: a keyed hash of (type, value, attempt) drives a generator that keeps
the format: lengths, separators, letter case and script, digits for digits, a
valid check digit for a valid card number, octets in range, the gender of a given
name. One value has one surrogate everywhere. Collision check, over all distinct
values of a type: a surrogate that another value has too, or that is itself a
value of the input, is generated again with the next attempt for all but the
smallest value. Values that are left after ``MAX_ATTEMPTS`` draws get the free
forms of their format by rank, in a keyed order of the format's forms (so these
depend on the other values of the input); when a format has no free form left,
its values get a longer one: any octets for an address, more characters
otherwise.

Defined cases: a null text stays null; overlapping detections keep the earlier,
then the longer one; rows of one doc_id are independent; a null doc_id is a row
like others; texts without entities pass through without any shuffle; extra
columns are kept, except one named n_entities, which is replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import exclusive_sums, materialise
from corvid.llm.mixing import permute

KEY = b"surrogate-key"
MAX_ATTEMPTS = 50
CODES = 10_000  # numbers of forms that one row stands for

# Titles with the gender they tell, and given names by gender.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Herrn": "m", "Frau": "f",
          "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f",
          "Господин": "m", "Госпожа": "f"}
GIVEN = {
    "latin": {
        "f": "Alice Anna Barbara Camille Carmen Charlotte Claire Elena Elizabeth Emily Emma Hannah Isabel Jennifer Jessica Julia "
             "Karen Katharina Laura Linda Lucía Margaret Maria María Marie Mary Nicole Olivia Patricia Sabine Sarah Sophie Susan Ursula".split(),
        "m": "Alexander Andrew Antoine Antonio Carlos Charles Daniel David Diego Edward François George Hans Henry James Javier Jean "
             "John José Jürgen Klaus Louis Luis Michael Miguel Nicolas Pablo Paul Peter Pierre Robert Stefan Thomas William".split(),
    },
    "cyrillic": {"f": "Анна Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
                 "m": "Александр Алексей Дмитрий Иван Михаил Николай Павел Сергей".split()},
}
SYLLABLES = {"latin": ("ba be bi bo da de do fa fe ga ge ha he ka ke ki la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi wa we").split(),
             "cyrillic": "ба бе бо ва ве ви да де до ка ке ко ла ле ли ма ме ми на не но ра ре ри са се си та те то".split()}
_SEX = {n: (script, g) for script, by in GIVEN.items() for g, names in by.items() for n in names}

_W = r"[^\W\d_]"
_CAP = rf"[A-ZÀ-ÖØ-ÞА-ЯЁ]{_W}+(?:[-'’][A-ZÀ-ÖØ-ÞА-ЯЁ]{_W}+)?"
_LOCAL, _DOMAIN = re.compile(r"[\w.+%-]+$"), re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_NUMBER = re.compile(r"(?<![\w.])[+(]?\d[\d ().\-/+]{5,}\d")  # a run that can hold several numbers
_IP = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}")
_CARD = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}")
_PHONE = re.compile(r"\+1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}|\+\d{1,3}(?:[ .\-]?(?:\(\d{1,4}\)|\d{2,4})){2,5}"
                    r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[ .\-]\d{3}[ .\-]\d{4}")
_SSN = re.compile(r"\d{3}-\d{2}-\d{4}")
_AKIA = re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)")
_SECRET = re.compile(r"(?i)(?<!\w)(?:password|passwd|pwd|token|secret|api_?key)\s*[=:]\s*[\"']?([A-Za-z0-9_+/.\-]{8,})")
_TITLED = re.compile(rf"(?<!\w)({'|'.join(TITLES)})\.? ({_CAP})(?: ({_CAP}))?")
_NAMED = re.compile(rf"(?<!\w)({'|'.join(_SEX)}) ({_CAP})")
_HAS_TITLE, _HAS_GIVEN = re.compile("|".join(TITLES)), re.compile(rf"(?:{'|'.join(_SEX)}) [A-ZÀ-ÖØ-ÞА-ЯЁ]")
_SECRET_WORD = re.compile(r"(?i)passw|pwd|token|secret|api_?key")


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities of a text, in order, not overlapping."""
    out = []
    at = text.find("@")
    while at >= 0:
        right = _DOMAIN.match(text, at + 1)
        left, back = None, 64
        while right:  # the local part, however long: it is read backwards
            left = _LOCAL.search(text, max(0, at - back), at)
            if not left or left.start() > at - back or back >= at:
                break
            back *= 2
        if left and right:
            out.append((left.start(), right.end(), "email"))
        at = text.find("@", at + 1)
    for m in _NUMBER.finditer(text):
        lo, hi = m.span()
        while lo < hi:
            for kind, pattern in (("ip", _IP), ("ssn", _SSN), ("card", _CARD), ("phone", _PHONE)):
                f = pattern.match(text, lo, hi)
                if f and not text[f.end():f.end() + 1].isalnum() and (kind != "ip" or all(int(x) < 256 for x in f.group().split("."))):
                    out.append((lo, f.end(), kind))
                    lo = f.end()
                    break
            else:
                lo += 1
                while lo < hi and text[lo - 1].isalnum():
                    lo += 1
    if "AKIA" in text or "ASIA" in text:
        out += [(*m.span(), "access_key") for m in _AKIA.finditer(text)]
    if _SECRET_WORD.search(text):
        out += [(*m.span(1), "secret") for m in _SECRET.finditer(text)]
    if _HAS_TITLE.search(text):
        for m in _TITLED.finditer(text):
            sex = TITLES[m.group(1)]
            if m.group(3):  # given name and surname
                out += [(*m.span(2), "given_" + (_SEX.get(m.group(2), ("", sex))[1] or "x")), (*m.span(3), "surname")]
            else:
                out.append((*m.span(2), "surname"))
    if _HAS_GIVEN.search(text):
        for m in _NAMED.finditer(text):
            out += [(*m.span(1), "given_" + _SEX[m.group(1)][1]), (*m.span(2), "surname")]
    kept, end = [], -1
    for s, e, k in sorted(set(out), key=lambda x: (x[0], -x[1])):
        if s >= end:
            kept.append((s, e, k))
            end = e
    return kept


# ---- surrogates -------------------------------------------------------------

class Draw:
    """Keyed pseudorandom choices for one (type, value, attempt)."""

    def __init__(self, key: bytes, *parts):
        self.key, self.seed, self.n, self.bits, self.left = key, "\x1f".join(map(str, parts)).encode(), 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 64:
            more = hmac.new(self.key, self.seed + b"\x1f%d" % self.n, hashlib.sha256).digest()
            self.bits, self.left, self.n = int.from_bytes(more, "big"), 256, self.n + 1
        self.bits, got = divmod(self.bits, 1 << 32)
        self.left -= 32
        return got * n >> 32

    def of(self, options):
        return options[self.below(len(options))]


def _alphabet(c: str) -> str:
    """Characters of the same kind, case and script; empty for one that stays."""
    if c.isdigit() and c.isascii():
        return "0123456789"
    if not c.isalpha():
        return ""
    if "а" <= c.lower() <= "я":
        same = "абвгдежзиклмнопрстуфхцчшя"
    elif "α" <= c.lower() <= "ω":
        same = "αβγδεζηθικλμνξοπρστυφχψω"
    elif c.isascii() or unicodedata.name(c, "").startswith("LATIN"):
        same = "abcdefghijklmnopqrstuvwxyz"
    else:
        return ""
    return same.upper() if c.isupper() else same


def _like(c: str, draw: Draw) -> str:
    same = _alphabet(c)
    return draw.of(same) if same else c


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _script(value: str) -> str:
    return "cyrillic" if any("а" <= c <= "я" for c in value.lower()) else "latin"


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A value of the same type and format, for good as long as the key is."""
    draw = Draw(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return "".join(_like(c, draw) for c in local) + "@" + "".join(_like(c, draw) for c in host) + "." + top
    if kind == "ip":
        return ".".join(str(_octet(x, draw)) for x in value.split("."))
    if kind in ("card", "phone", "ssn"):
        digits, keep = _digits(kind, value)
        out = list(value)
        for i in digits:
            if i >= keep:
                out[i] = draw.of("0123456789")
        if kind == "card" and luhn("".join(value[i] for i in digits)):
            _check(out, digits)
        return "".join(out)
    if kind == "access_key":
        return value[:4] + "".join(draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in value[4:])
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", value):
            return "".join(draw.of("0123456789abcdef") for _ in value)
        return "".join(_like(c, draw) for c in value)
    script = _script(value)
    if kind in ("given_f", "given_m") and attempt < 3:  # first the usual names, then made-up ones
        return draw.of(GIVEN[script][kind[-1]])
    ending = {"given_f": "a", "given_m": "n", "given_x": "i"}.get(kind, "r") if script == "latin" else \
        {"given_f": "а", "given_m": "н", "given_x": "и"}.get(kind, "в")
    return ("".join(draw.of(SYLLABLES[script]) for _ in range(2 + attempt // 4 + draw.below(2))) + ending).capitalize()


def _octets(x: str) -> range:
    lo, hi = {1: (0, 9), 2: (10, 99)}.get(len(str(int(x))), (100, 255))
    return range(lo, hi + 1)


def _octet(x: str, draw: Draw) -> int:
    return draw.of(_octets(x))


def _digits(kind: str, value: str) -> tuple[list[int], int]:
    """Places of the digits, and the place from which on they are replaced."""
    keep = 1 if kind == "card" else len(re.match(r"\+?\d{0,3}(?=\D)|", value).group()) if value[0] == "+" else 0
    return [i for i, c in enumerate(value) if c.isdigit()], keep


def _check(out: list[str], digits: list[int]) -> None:
    """Sets the last digit so that the check digit is valid."""
    for d in "0123456789":
        out[digits[-1]] = d
        if luhn("".join(out[i] for i in digits)):
            break


def options(kind: str, value: str) -> list[list[str]] | None:
    """The choices that ``surrogate`` has at each place of a value; None for
    names, which get longer with the attempts."""
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return [list(_alphabet(c) or c) for c in local] + [["@"]] + [list(_alphabet(c) or c) for c in host] + [["." + top]]
    if kind == "ip":
        parts = [[str(o) for o in _octets(x)] for x in value.split(".")]
        return [o for part in parts for o in (part, ["."])][:-1]
    if kind in ("card", "phone", "ssn"):
        digits, keep = _digits(kind, value)
        checked = digits[-1] if kind == "card" and luhn("".join(value[i] for i in digits)) else -1
        free = {i for i in digits if i >= keep and i != checked}
        return [list("0123456789") if i in free else ["?" if i == checked else c] for i, c in enumerate(value)]
    if kind == "access_key":
        return [[c] for c in value[:4]] + [list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in value[4:]]
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", value):
            return [list("0123456789abcdef") for _ in value]
        return [list(_alphabet(c) or c) for c in value]
    return None


def forms(choices: list[list[str]]) -> int:
    """Number of forms of a format, as far as a long can count them."""
    return min(math.prod(len(c) for c in choices), 1 << 62)


def form(kind: str, choices: list[list[str]], code: int) -> str:
    """The form with a number below ``forms``."""
    out = []
    for c in reversed(choices):
        code, k = divmod(code, len(c))
        out.append(c[k])
    out.reverse()
    if kind == "card" and "?" in out:
        _check(out, [i for i, c in enumerate(out) if c.isdigit() or c == "?"])
    return "".join(out)


def longer(key: bytes, kind: str, value: str, extra: int) -> str:
    """A surrogate of a wider format: any octets first, then more characters."""
    attempt = MAX_ATTEMPTS + extra
    if kind in ("surname", "given_f", "given_m", "given_x"):
        return surrogate(key, kind, value, attempt)  # made longer there
    draw = Draw(key, kind, value, attempt, "longer")
    if kind == "ip":
        out = ".".join(str(draw.below(256)) for _ in range(4))
        return out + "".join(draw.of("0123456789") for _ in range(extra - 1))
    out = surrogate(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = out.partition("@")
        return local + "".join(draw.of("abcdefghijklmnopqrstuvwxyz") for _ in range(extra)) + "@" + domain
    return out + "".join(draw.of("0123456789") for _ in range(extra))


def find_entities(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``__e``: start, end, type and value of each entity."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([[{"s": s, "e": e, "kind": k, "value": t[s:e]} for s, e, k in detect(t)] if isinstance(t, str) else []
                             for t in b])

    udf = F.pandas_udf(run, "array<struct<s:int,e:int,kind:string,value:string>>")
    return docs.withColumn("__e", udf(F.col(text)))


def surrogate_map(values: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, value, new)`` for distinct ``(kind, value)``: no surrogate twice
    within a type, none that is a value of the input."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(new=[surrogate(key, k, v, int(a)) for k, v, a in zip(b["kind"], b["value"], b["attempt"])])

    schema = "kind string, value string, attempt int, new string"
    values = materialise(values.select("kind", "value").distinct(), "pii-values")
    taken = values.select("kind", F.col("value").alias("new"), F.lit(1).alias("is_value"))
    now = materialise(values.withColumn("attempt", F.lit(0)).mapInPandas(make, schema), "pii-map")
    for _ in range(MAX_ATTEMPTS):
        j = _checked(now, taken)
        if not j.where("bad").limit(1).count():
            return j.select("kind", "value", "new")
        again = j.where("bad").select("kind", "value", (F.col("attempt") + 1).alias("attempt")).mapInPandas(make, schema)
        now = materialise(j.where("NOT bad").select("kind", "value", "attempt", "new").union(again), "pii-map")
    return _rest_by_rank(_checked(now, taken), taken, key)


def _checked(now: DataFrame, taken: DataFrame) -> DataFrame:
    """``now`` with ``bad``: a surrogate that a smaller value has too, or that is
    a value of the input."""
    first = now.groupBy("kind", "new").agg(F.min("value").alias("holder"))
    j = (now.join(first, ["kind", "new"]).join(taken, ["kind", "new"], "left")
         .withColumn("bad", (F.col("value") != F.col("holder")) | F.col("is_value").isNotNull()))
    return materialise(j.select("kind", "value", "attempt", "new", "bad"), "pii-checked")


def _rest_by_rank(j: DataFrame, taken: DataFrame, key: bytes) -> DataFrame:
    """Surrogates for the values that random draws left over, without chance:
    more and more codes of a format, in a keyed order, less those taken, are
    dealt to its values by rank, until all have one or all codes were seen;
    what is left then gets a longer format."""
    def formats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c = [options(k, v) for k, v in zip(b["kind"], b["value"])]
            yield pd.DataFrame({"kind": b["kind"], "value": b["value"],
                                "sig": [k + hashlib.sha256(repr(x).encode()).hexdigest() if x else None for k, x in zip(b["kind"], c)],
                                "n_forms": [forms(x) if x else 0 for x in c]})

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                choices = options(r.kind, r.like)
                order = int.from_bytes(hmac.new(key, r.sig.encode(), hashlib.sha256).digest()[:7], "big")
                codes = permute(np.arange(r.part * CODES, min((r.part + 1) * CODES, r.n_codes)), r.n_forms, order)
                yield pd.DataFrame({"kind": r.kind, "sig": r.sig, "new": [form(r.kind, choices, int(x)) for x in codes]})

    done = j.where("NOT bad").select("kind", "value", "new")
    left = materialise(j.where("bad").select("kind", "value").mapInPandas(formats, "kind string, value string, sig string, n_forms long"),
                       "pii-left")
    times = 4
    while True:
        open_ = left.where("sig IS NOT NULL").groupBy("kind", "sig", "n_forms").agg(F.min("value").alias("like"), F.count("*").alias("m"))
        # The last round that a format can have sees all its codes.
        open_ = materialise(open_.withColumn("n_codes", F.least("n_forms", F.col("m") * times)), "pii-formats")
        if not open_.limit(1).count():
            break
        codes = open_.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_codes") - 1) / CODES))))
        codes = codes.repartition(F.col("sig"), F.col("part")).mapInPandas(decode, "kind string, sig string, new string")
        free = (codes.join(taken, ["kind", "new"], "left_anti").join(done, ["kind", "new"], "left_anti")
                .groupBy("kind", "new").agg(F.min("sig").alias("sig")))
        free, rest = materialise(free.withColumn("one", F.lit(1)), "pii-free"), left.where("sig IS NOT NULL").withColumn("one", F.lit(1))
        a = exclusive_sums(free, "sig", ["new"], "one", "at", free.count())
        b = exclusive_sums(rest, "sig", ["value"], "one", "at", rest.count())
        got = materialise(b.drop("one").join(a.select("sig", "at", "new"), ["sig", "at"]).select("kind", "value", "new"), "pii-ranked")
        done = materialise(done.unionByName(got), "pii-done")
        seen = open_.where("n_codes = n_forms").select("sig", F.lit(True).alias("all_seen"))
        left = left.join(got, ["kind", "value"], "left_anti").join(seen, "sig", "left")
        left = materialise(left.select("kind", "value", F.when(F.col("all_seen").isNull(), F.col("sig")).alias("sig"), "n_forms"), "pii-left")
        times *= 4
    extra = 0
    while left.limit(1).count():
        extra += 1

        def widen(batches: Iterator[pd.DataFrame], extra=extra) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.assign(attempt=extra, new=[longer(key, k, v, extra) for k, v in zip(b["kind"], b["value"])])

        now = left.select("kind", "value").mapInPandas(widen, "kind string, value string, attempt int, new string")
        held = done.select("kind", "new", F.lit(1).alias("is_value")).unionByName(taken)
        j = _checked(materialise(now, "pii-longer"), held)
        done = materialise(done.unionByName(j.where("NOT bad").select("kind", "value", "new")), "pii-done")
        left = j.where("bad")
    return done


def replace_entities(docs: DataFrame, text: str = "text", key: bytes = KEY) -> DataFrame:
    """``docs`` with surrogates for all entities, and ``n_entities``."""
    names = [c for c in docs.columns if c != "n_entities"]
    marked = find_entities(docs.select(*names), text)
    # Only texts with entities are written and joined; the others pass through.
    hit = materialise(marked.where(F.size("__e") > 0).withColumn("__row", F.monotonically_increasing_id()), "pii-hits")
    each = hit.select("__row", F.explode("__e").alias("e")).select("__row", "e.*")
    new = materialise(surrogate_map(each, key).withColumnsRenamed({"kind": "__k", "value": "__v"}), "pii-surrogates")
    put = (each.join(new, (F.col("kind") == F.col("__k")) & (F.col("value") == F.col("__v")))
           .groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("s", "e", "new"))).alias("__p")).withColumnRenamed("__row", "__at"))
    done = hit.join(put, F.col("__row") == F.col("__at"))

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, puts in batches:
            out = []
            for t, p in zip(texts, puts):
                parts, at = [], 0
                for x in p:
                    parts += [t[at:x["s"]], x["new"]]
                    at = x["e"]
                out.append("".join([*parts, t[at:]]))
            yield pd.Series(out)

    udf = F.pandas_udf(run, "string")
    done = done.withColumn("__t", udf(F.col(text), F.col("__p")))
    changed = done.select(*[F.col("__t").alias(c) if c == text else F.col(c) for c in names], F.size("__e").cast("long").alias("n_entities"))
    same = marked.where(F.size("__e") == 0).select(*names, F.lit(0).cast("long").alias("n_entities"))
    return same.union(changed)
