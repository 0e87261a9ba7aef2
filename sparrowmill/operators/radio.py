"""Radio procedure in transcripts: numerals, call signs, records, grids, loops, markers."""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .filters import lookup

# The spelling alphabet, spoken digits, words heard in their place, and the closed lists of the report rules.
LETTERS = {
    "alfa": "A", "alpha": "A", "bravo": "B", "charlie": "C", "delta": "D", "echo": "E",
    "foxtrot": "F", "golf": "G", "hotel": "H", "india": "I", "juliett": "J", "juliet": "J",
    "kilo": "K", "lima": "L", "mike": "M", "november": "N", "oscar": "O", "papa": "P",
    "quebec": "Q", "romeo": "R", "sierra": "S", "tango": "T", "uniform": "U", "victor": "V",
    "whiskey": "W", "whisky": "W", "x-ray": "X", "xray": "X", "yankee": "Y", "zulu": "Z",
}
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "wun": "1", "two": "2", "too": "2", "three": "3", "tree": "3",
    "four": "4", "fower": "4", "for": "4", "five": "5", "fife": "5", "six": "6", "seven": "7", "eight": "8",
    "ait": "8", "nine": "9", "niner": "9",
}
HEARD = {"power": "4", "for": "4", "four's": "4", "to": "2", "too": "2", "won": "1", "free": "3", "fight": "5", "nicer": "9", "nina": "9", "ate": "8", "sex": "6", "fire": "5"}
GRID_WORDS = ["grid", "grade", "great", "grit", "greed", "greet", "grids"]
SIZES = ["platoon", "squad", "section", "company", "fire team", "team"]
DIRECTIONS = ["north east", "north west", "south east", "south west", "northeast", "northwest", "southeast", "southwest", "north", "south", "east", "west", "front", "rear", "left", "right"]
TYPES = {
    "medevac": ["medevac", "nine line", "9 line", "casevac", "casualt", "wounded", "urgent surgical"],
    "fire_mission": ["fire mission", "adjust fire", "fire for effect", "danger close", "shot over", "splash"],
    "contact_report": ["contact", "taking fire", "under fire", "engaging", "enemy", "hostile", "ambush", "sniper", "ied"],
    "radio_check": ["radio check", "how do you read", "loud and clear", "weak but readable"],
    "sitrep": ["sitrep", "situation report", "no contact", "all clear", "ammo"],
    "movement": ["moving to", "rally point", "phase line", "en route", "eta", "holding at", "wilco"],
    "check_fire": ["check fire", "cease fire"],
}
CONFIRMED = 0.75
UNRELIABLE = "[unreliable: repetition]"
TOKEN = r"[a-z0-9\-']+|[,.?!]"
# Kinds of tokens: d digits, h heard for a digit, f heard but never first in a run, g a misheard grid, c a comma or stop inside runs, o others.
_KIND = {**dict.fromkeys(GRID_WORDS, "g"), **dict.fromkeys(",.", "c"), **dict.fromkeys(HEARD, "h"), "fire": "f", **dict.fromkeys(DIGITS, "d")}
_RUN = re.compile("(?:d|h(?=d))(?:[dhf]|c(?=d))*|g(?=d|[hf]d)")


def bound(value: Column, f) -> Column:
    """f of a value that is worked out once for a row, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def radio_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def digit_of(word: Column) -> Column:
    """Digits of a spoken digit or a written number, else null."""
    return F.when(word.rlike("^[0-9]+$"), word).otherwise(lookup(word, DIGITS))


def _joined(texts: list[str]) -> list[str]:
    """Lower-case texts with runs of digits joined; all of them in one list of tokens, a line feed between two."""
    toks = re.findall(TOKEN + "|\n", "\n".join([t.replace("\n", " ") for t in texts]))
    kinds = "".join([_KIND.get(t) or ("d" if t.isdigit() else "o") for t in toks])
    out, end = [], 0
    for m in _RUN.finditer(kinds):
        i, j = m.span()
        out += toks[end:i]
        out.append("grid" if kinds[i] == "g" else "".join([HEARD.get(t) or DIGITS.get(t, t) for t in toks[i:j] if t not in ",."]))
        end = j
    joined = " ".join(out + toks[end:])
    for mark in ",.?!":
        joined = joined.replace(" " + mark, mark)
    return [t.strip(" ") for t in joined.split("\n")]


@F.pandas_udf(StringType())
def _normalised(text: pd.Series) -> pd.Series:
    """A few texts at a time, so that long ones are not all held as tokens."""
    out, some, size = [], [], 0
    for t in text:
        some.append(t)
        size += len(t)
        if size > 1 << 18:
            out += _joined(some)
            some, size = [], 0
    return pd.Series(out + (_joined(some) if some else []), dtype=object)


def normalise_numerals(text: Column) -> Column:
    """Runs of spoken digits become one number; commas and stops inside a run vanish; words that
    are heard for digits count only beside digits; a misheard `grid` before a number is mended.

    One pass over the tokens of a text, as an Arrow function: use it in a column of its own where
    it is read often, and not inside a lambda."""
    return _normalised(F.lower(F.coalesce(text, F.lit(""))))


def radio_words(text: Column) -> Column:
    return F.filter(radio_tokens(text), lambda t: ~t.isin(*",.?!"))


def callsign_at(words: Column, i: Column) -> Column:
    """Struct (sign, stop) of a letter word and one or two digit words at i (from 0), else null."""
    # Digits are looked up only behind a letter.
    parts = bound(lookup(F.get(words, i), LETTERS), lambda x: F.when(x.isNotNull(), F.struct(x.alias("letter"), digit_of(F.get(words, i + 1)).alias("one"), digit_of(F.get(words, i + 2)).alias("two"))))
    sign = lambda x: F.struct(F.concat(x["letter"], x["one"], F.coalesce(x["two"], F.lit(""))).alias("sign"), (i + F.when(x["two"].isNotNull(), 3).otherwise(2)).alias("stop"))
    return F.when(i >= 0, bound(parts, lambda x: F.when(x["one"].isNotNull(), sign(x))))


def _first(found: Column, names: list[str], test) -> Column:
    out = F.when(F.lit(False), "")
    for n in names:
        out = out.when(test(found, n), n)
    return out


def with_extraction(df: DataFrame, text: str) -> DataFrame:
    """Adds the fields of a report, null where the text does not give them: receiver, sender,
    grids, types, contact, size, direction, distance, casualties, closing, unreliable.

    Null text counts as empty. Lists are tried in their order and the first entry counts."""
    w, low, norm, k, calls, types = map(F.col, ("_w", "_low", "norm", "_k", "_calls", "types"))
    # A column of its own for what several fields read: each is worked out once for a row.
    d = df.withColumn("_w", radio_words(F.col(text))).withColumn("_low", F.array_join("_w", " ")).withColumn("norm", normalise_numerals(F.col(text)))
    # Words before it: they are joined by single spaces.
    head = bound(F.trim(F.substring_index(low, "this is", 1)), lambda h: F.when(h == "", 0).otherwise(F.length(h) - F.length(F.replace(h, F.lit(" "))) + 1))
    d = d.withColumn("_k", F.when(low.contains("this is"), head))
    signs = F.filter(F.transform(F.sequence(F.greatest(F.lit(0), k - 4), F.greatest(F.lit(0), k - 1)), lambda i: callsign_at(w, i)), lambda c: c.isNotNull() & (c["stop"] <= k))
    numbers = lambda pattern: F.get(F.regexp_extract_all(norm, F.lit(pattern), F.lit(1)), F.lit(0))
    kinds = F.array_compact(F.array(*[F.when(reduce(or_, [low.contains(key) for key in keys]), t) for t, keys in TYPES.items()]))
    d = d.withColumns({"_calls": signs, "types": kinds})
    bad = F.coalesce(F.col(text), F.lit("")).contains("[unreliable")
    grids = F.filter(F.regexp_extract_all(F.replace(norm, F.lit(","), F.lit(" ")), F.lit(r"grid ([0-9]+)"), F.lit(1)), lambda g: F.length(g).isin(4, 6, 8, 10))
    fields = {
        "receiver": F.when(k.isNotNull(), F.get(calls, F.lit(0))["sign"]).otherwise(callsign_at(w, F.lit(0))["sign"]),
        "sender": F.when(k.isNotNull(), callsign_at(w, k + 2)["sign"]),
        "grids": F.when(bad, F.array().cast("array<string>")).otherwise(grids),
        "contact": F.array_contains(types, "contact_report") & ~low.contains("no contact"),
        "size": F.coalesce(_first(low, SIZES, lambda c, n: c.contains(n)), numbers(r"([0-9]+) (?:enemy|hostiles?|troops|vehicles?|pax)")),
        "direction": _first(low, DIRECTIONS, lambda c, n: c.contains(n) & c.rlike(rf"\b{n}\b")),
        "distance": numbers(r"([0-9]+ (?:meters|metres|klicks|kilometers|km))"),
        "casualties": numbers(r"([0-9]+) (?:urgent|casualt\w*|wounded|kia|wia)").cast("int"),
        "closing": F.when(low.rlike(r"\bout\b\W*$"), "out").when(low.rlike(r"\bover\b\W*$"), "over"),
        "unreliable": bad,
    }
    return d.withColumns(fields).drop("_w", "_low", "_k", "_calls")


def grounded(value: Column, text: Column) -> Column:
    """Every word and digit run of the value occurs in the text or in its normalised form."""
    return _in_forms(value, F.struct(F.lower(F.coalesce(text, F.lit(""))).alias("low"), normalise_numerals(text).alias("norm")))


def _in_forms(value: Column, forms: Column) -> Column:
    parts = F.regexp_extract_all(F.lower(value.cast("string")), F.lit("[a-z]+|[0-9]+"), F.lit(0))
    return bound(forms, lambda x: F.forall(parts, lambda t: x["norm"].contains(t) | x["low"].contains(t)))


def grid_to_xy(grid: Column) -> Column:
    """Centre (easting, northing) in metres within the 100 km square and half the side of the box."""
    n = (F.length(grid) / 2).cast("int")
    res = F.pow(F.lit(10), 5 - n).cast("long")
    mid = lambda part: part.cast("long") * res + F.floor(res / 2)
    ok = F.length(grid).isin(4, 6, 8, 10) & grid.rlike("^[0-9]+$")
    return F.when(ok, F.struct(mid(F.substring(grid, F.lit(1), n)).alias("easting"), mid(F.substring(grid, n + 1, n)).alias("northing"), (res / 2).alias("half")))


def xy_to_grid(easting: Column, northing: Column, digits: int = 8) -> Column:
    """Digits of the box that holds a point of the 100 km square."""
    part = lambda v: F.substring(F.lpad(F.floor(v).cast("string"), 5, "0"), 1, digits // 2)
    return F.concat(part(easting), part(northing))


def utm_to_latlon(easting: Column, northing: Column, zone: int) -> Column:
    """Latitude and longitude of a northern UTM point: the transverse Mercator inverse series in
    the third flattening (Kruger), on WGS 84."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)

    def sphere(p):
        x1, e1 = xi, eta = p["xi"], p["eta"]
        for j, b in enumerate(beta, 1):
            x1 = x1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            e1 = e1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return F.struct(x1.alias("x1"), e1.alias("e1"))

    def place(p):
        lat = chi = p["chi"]
        for j, d in enumerate(delta, 1):
            lat = lat + d * F.sin(2 * j * chi)
        return F.struct(F.degrees(lat).alias("lat"), F.degrees(p["lon"]).alias("lon"))

    angles = lambda p: F.struct(F.asin(F.sin(p["x1"]) / F.cosh(p["e1"])).alias("chi"), (math.radians(6 * zone - 183) + F.atan2(F.sinh(p["e1"]), F.cos(p["x1"]))).alias("lon"))
    flat = F.struct((northing / (0.9996 * big)).alias("xi"), ((easting - 500000.0) / (0.9996 * big)).alias("eta"))
    return bound(bound(bound(flat, sphere), angles), place)


def square_origin(square: str) -> tuple[int, float, float]:
    """Zone and south-west corner of a northern 100 km square such as 33UVP. Columns repeat every
    three zones, rows every 2,000 km and start at F in even zones; the band tells which of them."""
    zone, band, col, row = int(square[:-3]), square[-3], square[-2], square[-1]
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZ"
    easting = (letters.index(col) - 8 * ((zone - 1) % 3) + 1) * 100_000.0
    northing = (letters.index(row) - (5 if zone % 2 == 0 else 0)) % 20 * 100_000.0
    least = (letters.index(band) - letters.index("N")) * 8 * 110_000.0
    while northing < least:
        northing += 2_000_000.0
    return zone, easting, northing


def grid_to_latlon(grid: Column, square: str = "33UVP") -> Column:
    zone, e, n = square_origin(square)

    def latlon(xy):
        at = utm_to_latlon(xy["easting"] + e, xy["northing"] + n, zone)
        return F.when(xy.isNotNull(), bound(at, lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), xy["half"].alias("half"))))

    return bound(grid_to_xy(grid), latlon)


def number_confidence(number: Column, words: Column) -> Column:
    """Mean word probability over the digits of a number, null if the words do not hold it.
    `words`: array<struct<w, p>> in order."""
    def digits(x):
        d = bound(F.regexp_replace(F.lower(x["w"]), r"^[.,?!]+|[.,?!]+$", ""), lambda t: F.coalesce(digit_of(t), lookup(t, HEARD)))
        return F.transform(F.filter(F.split(F.coalesce(d, F.lit("")), ""), lambda c: c != ""), lambda c: F.struct(c.alias("d"), x["p"].cast("double").alias("p")))

    def mean(x):
        part = F.slice(x["flat"], F.greatest(x["at"], F.lit(1)), F.length(number))
        return F.when(x["at"] > 0, F.aggregate(part, F.lit(0.0), lambda s, v: s + v["p"]) / F.length(number))

    place = lambda flat: F.struct(flat.alias("flat"), F.instr(F.array_join(F.transform(flat, lambda s: s["d"]), ""), number).alias("at"))
    return bound(bound(F.flatten(F.transform(words, digits)), place), mean)


def loop_cut(words: Column, most: int) -> Column:
    """Number of words before the first that continues a run beyond `most`; all if none does. One pass."""
    def step(s, w):
        run = F.when(w == s["last"], s["run"] + 1).otherwise(F.lit(1))
        cut = F.when((s["cut"] < 0) & (run > most), s["i"]).otherwise(s["cut"])
        return F.struct(w.alias("last"), run.alias("run"), (s["i"] + 1).alias("i"), cut.alias("cut"))
    zero = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("i"), F.lit(-1).alias("cut"))
    # A word equal to a null `last` is unknown, so the first word starts a run.
    return F.aggregate(words, zero, lambda s, w: step(s, w), lambda s: F.when(s["cut"] < 0, s["i"]).otherwise(s["cut"]))


def collapse_loops(text: Column, most: int = 5) -> Column:
    """Text cut where a word has been repeated more than `most` times, with a mark behind; other texts unchanged."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    bare = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"^[,.]+|[,.]+$", "")))
    cut = loop_cut(bare, most)
    return F.when(cut < F.size(words), F.concat(F.array_join(F.slice(words, F.lit(1), cut), " "), F.lit(" " + UNRELIABLE))).otherwise(text)


def expand_words(df: DataFrame, key: str, word: str, start: str, stop: str) -> DataFrame:
    """Numbers in a word become digit words that share its span evenly: key, pos, w, start, stop."""
    names = {"0": "zero", "1": "one", "2": "two", "3": "three", "4": "four", "5": "five", "6": "six", "7": "seven", "8": "eight", "9": "nine"}
    digits = F.regexp_extract_all(F.col(word), F.lit("[0-9]"), F.lit(0))
    parts = F.when(F.size(digits) > 0, F.transform(digits, lambda d: lookup(d, names))).otherwise(F.array(F.lower(word)))
    t = df.select(key, start, stop, F.size(parts).alias("_n"), F.posexplode(parts).alias("pos", "w"))
    step = (F.col(stop) - F.col(start)) / F.col("_n")
    return t.select(key, "pos", "w", (F.col(start) + F.col("pos") * step).alias("start"), (F.col(start) + (F.col("pos") + 1) * step).alias("stop"))


def check_citations(text: Column, known: Column) -> Column:
    """Struct of the cited ids that exist (tx.. or op.. in brackets) and `unverified`: none of them, and no `not reported`."""
    cited = F.regexp_extract_all(text, F.lit(r"\[(tx[0-9]+|op[0-9]+)\]"), F.lit(1))
    valid = F.filter(cited, lambda c: F.array_contains(known, c))
    return F.struct(valid.alias("citations"), ((F.size(valid) == 0) & ~F.lower(text).contains("not reported")).alias("unverified"))


def merge_decisions(types: Column, decided: Column, confidence: Column, contact: Column, score: Column) -> Column:
    """Types with the decided one if its confidence is above 0.6; contact also if its score is above 0.7."""
    extra = F.coalesce(decided.isNotNull() & (confidence > 0.6), F.lit(False))
    return F.struct(F.when(extra, F.array_union(types, F.array(decided))).otherwise(types).alias("types"), (F.coalesce(contact, F.lit(False)) | F.coalesce(score > 0.7, F.lit(False))).alias("contact"))


def markers(reports: DataFrame, tx: str, ts: str, words: str | None = None, square: str = "33UVP") -> DataFrame:
    """A marker per grid of a report (output of `with_extraction`): kind by the priority of its types,
    place, confidence, and a mark on those below the limit. Stateless, for a batch or a stream."""
    g = reports.withColumn("grid", F.explode("grids"))
    has = lambda t: F.array_contains("types", t)
    kind = F.when(has("medevac"), "casualty").when(has("check_fire"), "check_fire").when(has("fire_mission"), "fire_mission").when(F.col("contact"), "enemy").when(F.col("sender").isNotNull(), "friendly").otherwise("note")
    conf = number_confidence(F.col("grid"), F.col(words)) if words else F.lit(None).cast("double")
    g = g.withColumns({"_kind": kind, "_conf": conf, "_at": grid_to_latlon(F.col("grid"), square)})
    kind, conf, at = F.col("_kind"), F.col("_conf"), F.col("_at")
    label = (F.when(kind == "casualty", F.concat(F.lit("CASEVAC "), F.coalesce(F.col("casualties").cast("string"), F.lit("?")), F.lit(" urgent"))).when(kind == "check_fire", "CHECK FIRE")
             .when(kind == "fire_mission", "Fire mission").when(kind == "enemy", F.trim(F.concat(F.lit("Enemy "), F.coalesce("size", F.lit(""))))).when(kind == "friendly", F.col("sender")).otherwise("Position"))
    sure = F.coalesce(conf >= CONFIRMED, F.lit(True))
    return g.select(F.col(tx), F.col(ts), "grid", kind.alias("kind"), F.when(sure, label).otherwise(F.concat(F.lit("UNCONFIRMED "), label)).alias("label"), "sender",
                    at["lat"].alias("lat"), at["lon"].alias("lon"), at["half"].alias("half_m"), conf.alias("confidence"), sure.alias("confirmed"))


def enrich(df: DataFrame, fields: list[str], text: str) -> DataFrame:
    """Keeps a proposed field only if it is grounded in the text and no rule contradicts it: adds
    `kept` and `dropped` (sorted names). `df` holds the fields and the columns of `with_extraction`."""
    sign = lambda c: bound(radio_words(F.col(c)), lambda w: callsign_at(w, F.lit(0))["sign"])
    conflict = {
        "sender_said": sign("sender_said") != F.col("sender"),  # unknown where either is
        "receiver_said": sign("receiver_said") != F.col("receiver"),
        "grid_digits": (F.size("grids") > 0) & ~F.array_contains("grids", F.regexp_replace(normalise_numerals(F.col("grid_digits")), "[^0-9]", "")),
        "direction_said": ~F.lower(F.trim("direction_said")).isin(DIRECTIONS),
        "enemy_size": ~F.col("contact"), "enemy_activity": ~F.col("contact"),
    }
    filled = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    forms = F.struct(F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"), "norm")
    ok = {c: F.coalesce(filled(c) & _in_forms(F.col(c), F.col("_forms")) & ~F.coalesce(conflict.get(c, F.lit(False)), F.lit(False)), F.lit(False)) for c in fields}
    judged = df.withColumn("_forms", forms).withColumn("_ok", F.struct(*[ok[c].alias(f"f{i}") for i, c in enumerate(fields)]))
    pick = lambda want: F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"_ok.f{i}") == want, c) for i, c in enumerate(fields)])))
    return judged.withColumn("kept", pick(True)).withColumn("dropped", pick(False)).drop("_forms", "_ok")


def snapshot(marks: DataFrame, transmissions: DataFrame, ts: str, last: int = 200, kind: str | None = None) -> DataFrame:
    """All markers, of one kind if asked, and the last transmissions, in one table with `record`."""
    m = marks if kind is None else marks.where(F.col("kind") == kind)
    return m.withColumn("record", F.lit("marker")).unionByName(transmissions.orderBy(F.desc(ts)).limit(last).withColumn("record", F.lit("transmission")), allowMissingColumns=True)
