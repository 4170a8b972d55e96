"""Mentions of people's data in texts, and the texts with a typed placeholder for each.

A placeholder holds a pseudonym, so that equal values stay linked across documents: ``[PHONE:163-7321-0098]``. Digits of
validated numbers are permuted by a keyed Feistel network within their format; of a citizen number the region, the date of
birth (to another date) and the serial number each, and the check digit is made anew. The same digits give the same
pseudonym however they are spaced. What has no such format (addresses, names, mailboxes, partly masked or invalid numbers)
gets a keyed digest. Who has the key can compute the numbers back with ``Feistel.inverse``; there is no table of values.

A person is a full name of the roster, a new combination of its surnames and given names, or a name where the
wording asks for one, as not everybody named is on the roster.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import spread, table, text_batches

#: The key of the pseudonyms unless a caller gives another one, and the rounds of the network.
KEY, ROUNDS = b"millrace", 10
#: Wide forms to usual ones, one character each, so that positions stay.
_NARROW = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F) if chr(c) not in "，。：；！？（）"} | {0x3000: 0x20, 0xA0: 0x20}
_NO_CASE = r"(?<!Build )(?<!build )(?<!构建号 )(?<!构建号)(?<!Epoch )(?<!时间戳 )(?<!Trace )(?<!链路编号 )"
EMAIL = re.compile(
    r"(?i)(?<![A-Za-z0-9_.+-])(?!(?:root|git)@)[a-z0-9][a-z0-9._%+*-]*\s?(?:@|\[at\]|\(at\)|\{at\})\s?[a-z0-9*-]+(?:\s?(?:\.|\[dot\]|\(dot\)|\{dot\})\s?[a-z0-9*-]+)*?"
    r"(?:\s?(?:\.|\[dot\]|\(dot\)|\{dot\})\s?[a-z]{2,}(?![A-Za-z0-9_-]))(?:(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?)[a-z]{2,}(?![A-Za-z0-9_-]))*"
    r"|(?<![\w.+-])[a-z0-9][a-z0-9._+-]* at [a-z0-9-]+(?: dot [a-z0-9-]+)+"
)
ID_NUMBER = re.compile(
    r"(?<![A-Za-z0-9_.])" + _NO_CASE + r"\d{6}[ -]?(?:(?:19|20)\d{2}[ -]?(?:0[1-9]|1[0-2])[ -]?(?:[0-2]\d|3[01])|[*•xX]{8})[ -]?[\d*]{3}[\dXx*](?![A-Za-z0-9_])"
    r"|(?<![A-Za-z0-9_.-])(?:\d{3}|[*xX]{3})[- ](?:\d{2}|[*xX]{2})[- ]\d{4}(?![\w-])"
    r"|(?i:(?<=passport no\. )|(?<=passport )|(?<=passport number ))[A-Z]{1,2} ?[\d*]{6,9}(?!\w)"
    r"|(?<![A-Za-z0-9_-])[A-Z]{1,2}[\d*]{7,8}(?![A-Za-z0-9_-])|(?<=DNI )\d{8}-?[A-Z]\b"
)
ADDRESS = re.compile(
    r"(?<![\w.])\d{1,5} (?:[A-Z][\w'’-]+ ){1,3}(?:Street|Court|Drive|Lane|Road|Avenue|Way|Place|Boulevard|Terrace|Square|St|Ave|Rd|Dr|Ln|Blvd)\b"
    r"|[A-ZÄÖÜ][\wäöüß-]*(?:straße|strasse|str\.|weg|allee|gasse|platz|ring|ufer|damm) \d{1,4}\s?[a-z]?\b"
    r"|(?:[一-鿿]{2,8}(?:路|街|巷|大道|道|弄|胡同))\s?\d{1,5}\s?号"
    r"|\b(?:Calle|Avenida|Avda\.|Paseo|Plaza|Camino)(?: (?:de|del|la|las|los|el))* [A-ZÁÉÍÓÚ][\wáéíóúñ]*(?: (?:de|del|la|[A-ZÁÉÍÓÚ][\wáéíóúñ]*))*,? (?:n\.?º ?)?\d{1,4}\b"
)
PHONE = re.compile(
    r"(?<![A-Za-z0-9_.+/=-])" + _NO_CASE + r"(?:"
    r"\+\d{1,3}[ .-]?(?:\(?[\d*]+\)?[ .-]?){1,5}[\d*]{2,}"
    r"|(?:0086|86)?[ -]?1[3-9]\d[ -]?[\d*]{4}[ -]?[\d*]{4}"
    r"|(?:1[ -])?\([2-9]\d{2}\) ?\d{3}[ .-]\d{4}|(?:1[ .-])?[2-9]\d{2}([.-])\d{3}\1\d{4}|(?:1[ .-])?[2-9]\d{2} \d{3} \d{4}"
    r"|\(?0\d{2,4}\)?[ /-]\d{4,8}(?:[ -]\d{1,4})?)(?![A-Za-z0-9_-]|\.\d)"
)
_HAN = r"[一-鿿·]"
_CAP = r"[A-ZÄÖÜÁÉÍÓÚ][a-zäöüßáéíóúñ'’]+(?:-[A-ZÄÖÜÁÉÍÓÚ][a-zäöüßáéíóúñ'’]+)?"
_TWO = rf"({_CAP}(?: [A-Z]\.)?(?: {_CAP}){{1,2}})"
ASKED = [
    re.compile(rf"(?:值班人|联系人[：:]\s?|负责人[：:]?\s?)({_HAN}{{2,4}})(?=\s?[，,。；])"),
    re.compile(rf"(?:上次由)({_HAN}{{2,4}}?)(?=定位)"),
    re.compile(rf"(?:同步给)({_HAN}{{2,4}}?)(?=[，,])"),
    re.compile(rf"(?:^|(?<=[\s。，；>*)）】\]}}]))(?:据)?({_HAN}{{2,4}}?)(?=在群里确认过)", re.M),
    re.compile(rf"据({_HAN}{{2,4}}?)(?=回忆)"),
    re.compile(rf"请找({_HAN}{{2,4}}?)(?=(?:工程师|老师|经理|主管))"),
    re.compile(rf"(?:Contact: ?|[Ee]ngineer |changes go to |\bAs |It was |\bDr\. |\bMr\. |\bMs\. |\bMrs\. |Ansprechpartner(?:in)?: ?|Contacto: ?){_TWO}"),
    re.compile(rf"{_TWO}(?= (?:traced it|recalls|who tuned|reviewed|confirmed|hat |erinnert))"),
]


def finder(roster: Sequence[str]) -> Callable[[str | None], list[tuple[str, int, int]]]:
    """Finds (kind, start, end) of all mentions of a text, sorted; a stretch has one kind."""
    han = [n for n in roster if re.fullmatch(r"[一-鿿]+", n)]
    latin = [n.split(" ") for n in roster if " " in n]
    surnames = sorted({n[: len(n) - 2] for n in han if len(n) > 2}, key=len, reverse=True)
    given = {n[-2:] for n in han if len(n) > 2}
    names = []
    if surnames:
        names.append(f"(?:{'|'.join(map(re.escape, surnames))})(?:{'|'.join(map(re.escape, sorted(given)))})")
    if latin:
        first, last = {n[0] for n in latin}, {" ".join(n[1:]) for n in latin}
        one = lambda x: "|".join(map(re.escape, sorted(x, key=lambda s: (-len(s), s))))
        names.append(rf"(?<![\w-])(?:{one(first)})\s(?:{one(last)})(?![\w-])")
    rest = [n for n in han if len(n) <= 2]
    names.extend([f"(?:{'|'.join(map(re.escape, rest))})"] * bool(rest))
    known = re.compile("|".join(names)) if names else None

    def find(text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        t = text.translate(_NARROW)
        taken: list[tuple[str, int, int]] = []

        def add(kind: str, a: int, b: int) -> None:
            if all(b <= x or a >= y for _, x, y in taken):
                taken.append((kind, a, b))

        for kind, pattern in (("email", EMAIL), ("id_number", ID_NUMBER), ("address", ADDRESS), ("phone", PHONE)):
            for m in pattern.finditer(t):
                add(kind, *m.span())
        if known:
            for m in known.finditer(t):
                add("person", *m.span())
        for pattern in ASKED:
            for m in pattern.finditer(t):
                if not re.search(r"street|court|drive|^(?:The|This|If|When|Once|Only|Where)\b", m[1], re.I):
                    add("person", *m.span(1))
        return sorted(taken, key=lambda x: x[1])

    return find


class Feistel:
    """A keyed permutation of the numbers below any bound: a balanced network, walked until the value is below it."""

    def __init__(self, key: bytes = KEY):
        self.key = key[:64]

    def _round(self, i: int, half: int, tweak: str, bits: int) -> int:
        data = f"{i}|{half}|{tweak}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big") & ((1 << bits) - 1)

    def _walk(self, n: int, bound: int, tweak: str, back: bool) -> int:
        if not 0 <= n < bound:
            raise ValueError(f"{n} isn't below {bound}")
        bits = max(1, ((bound - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            x, y = n >> bits, n & mask
            for i in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                x, y = (y ^ self._round(i, x, tweak, bits), x) if back else (y, x ^ self._round(i, y, tweak, bits))
            n = x << bits | y
            if n < bound:
                return n

    def forward(self, n: int, bound: int, tweak: str = "") -> int:
        return self._walk(n, bound, tweak, False)

    def inverse(self, n: int, bound: int, tweak: str = "") -> int:
        return self._walk(n, bound, tweak, True)

    def digits(self, s: str, tweak: str, back: bool = False) -> str:
        """Digits to as many digits."""
        return f"{self._walk(int(s), 10 ** len(s), f'{tweak}{len(s)}', back):0{len(s)}d}" if s else s

    def tag(self, text: str, kind: str) -> str:
        """A keyed digest of a value, in lower case and without blanks, that can't be turned back."""
        return hashlib.blake2b(f"{kind}|{re.sub(r'\s+', '', text).lower()}".encode("utf-8", "surrogatepass"), key=self.key, digest_size=5).hexdigest()


_EPOCH = datetime.date(1900, 1, 1)
_DAYS = (datetime.date(2100, 1, 1) - _EPOCH).days
#: Weights of the digits of a citizen number and the check sign for each remainder (ISO 7064, mod 11-2).
_WEIGHTS, _CHECKS = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2), "10X98765432"


def check_sign(seventeen: str) -> str:
    return _CHECKS[sum(int(d) * w for d, w in zip(seventeen, _WEIGHTS)) % 11]


def citizen_number(s: str) -> bool:
    """Whether 18 signs are a citizen number with an existing date and the right check sign."""
    if not re.fullmatch(r"\d{17}[\dX]", s) or check_sign(s[:17]) != s[17]:
        return False
    try:
        return 1900 <= datetime.date(int(s[6:10]), int(s[10:12]), int(s[12:14])).year < 2100
    except ValueError:
        return False


def permuted_citizen(s: str, keyed: Feistel, back: bool = False) -> str:
    """Another valid citizen number: region, date and serial number permuted, the check sign made anew."""
    day = (datetime.date(int(s[6:10]), int(s[10:12]), int(s[12:14])) - _EPOCH).days
    date = _EPOCH + datetime.timedelta(days=keyed._walk(day, _DAYS, "birth", back))
    body = f"{keyed.digits(s[:6], 'region', back)}{date:%Y%m%d}{keyed.digits(s[14:17], 'serial', back)}"
    return body + check_sign(body)


def pseudonym(kind: str, value: str, keyed: Feistel) -> str:
    """The pseudonym of a value; validated numbers keep their separators and letters, the rest becomes a digest."""
    v = value.translate(_NARROW).strip()
    bare = re.sub(r"[^0-9A-Za-z*]", "", v).upper()
    if kind == "id_number" and len(bare) == 18:
        if not citizen_number(bare):
            return keyed.tag(bare, kind)
        new = iter(permuted_citizen(bare, keyed))
        return "".join(next(new) if c.isalnum() else c for c in v)
    number = re.sub(r"\D", "", v)
    if kind == "phone":
        body = re.sub(r"[^\d*]", "", re.sub(r"^(?:(?:00|\+)(?:86|1(?!\d{10}\d))|86(?=[ -]?1[3-9])|1(?=[ .-]\(?[2-9]))", "", v))
        if not body.isdigit() or not 6 <= len(body) <= 15:
            return keyed.tag(v, kind)
        kept = len(number) - len(body)  # a country code stays
        new = iter(number[:kept] + keyed.digits(body, "phone"))
        return "".join(next(new) if c.isdigit() else c for c in v)
    if kind == "id_number" and re.fullmatch(r"\d{9}|[A-Z]{1,2}\d{7,9}|\d{8}[A-Z]", bare):
        new = iter(keyed.digits(number, "id"))
        return "".join(next(new) if c.isdigit() else c for c in v)
    return keyed.tag(v, kind)


def masked(text: str | None, found: list[tuple[str, int, int]], keyed: Feistel | None = None) -> str | None:
    """The text with a placeholder for each mention: its type and, with a key, its pseudonym."""
    for kind, a, b in reversed(found):
        text = f"{text[:a]}[{kind.upper()}{':' + pseudonym(kind, text[a:b], keyed) if keyed else ''}]{text[b:]}"
    return text


# --- Spark ---


def mask_personal(df: DataFrame, keys: Sequence[str], text: str, roster: Sequence[str], key: bytes = KEY) -> DataFrame:
    """``keys``, masked and kinds (array<string>: the kind of each placeholder, in order) of every row; no shuffle.

    A null text gives null and no kinds, a text without mentions comes back as it is. Other columns of ``df`` are ignored,
    repeated rows stay. ``roster`` are known full names, a list of bounded size that every worker gets.
    """
    text_batches(df.sparkSession)
    names = sorted({r for r in roster if r and r.strip()})
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema), "masked string, kinds array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, keyed = finder(names), Feistel(key)
        for b in batches:
            texts = b.column("_text").to_pylist()
            found = [find(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(k) for k in keys),
                    pa.array([masked(t, f, keyed) for t, f in zip(texts, found)], pa.string()),
                    pa.array([[k for k, _, _ in f] for f in found], pa.list_(pa.string())),
                ],
                names=[*keys, "masked", "kinds"],
            )

    return spread(df.select(*keys, F.col(text).cast("string").alias("_text"))).mapInArrow(run, fields)


def p2_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, row_id, masked, kinds of every text of sections, answers and images."""
    parts = [("section", "sections", "section_id", "body"), ("qa", "qa_units", "qa_id", "answer"), ("image", "images", "image_id", "vision_text")]
    one, *more = [table(spark, sf_dir, t).select(F.lit(src).alias("src"), F.col(key).cast("long").alias("row_id"), F.col(c).alias("text")) for src, t, key, c in parts]
    for m in more:
        one = one.unionByName(m)
    roster = [r[0] for r in table(spark, sf_dir, "staff_roster").select("full_name").collect()]  # a fixed table
    return mask_personal(one, ["src", "row_id"], "text", roster)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each placeholder that the masked text holds; nth counts those of its kind."""
    at = p2_masked(spark, sf_dir).select("src", "row_id", "kinds", F.posexplode("kinds").alias("at", "kind"))
    nth = F.size(F.filter(F.slice("kinds", F.lit(1), F.col("at") + 1), lambda k: k == F.col("kind")))
    return at.select("src", "row_id", "kind", nth.cast("int").alias("nth"))
