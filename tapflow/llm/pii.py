"""Operator 4, personal data: weak supervision over candidate spans (native).

Base spans (email, ip, card, phone) are found by the contract's patterns and
always stay.  Weaker candidates are judged together with the base ones: emails
written with "(at)", ibans, social security numbers, street addresses, names
after a cue, cards in groups of four, and other numbers in groups.

* Five labelers vote +1, -1 or abstain (0) on every candidate, each by rules of
  its kind: ``check`` (Luhn, mod 97, issued number ranges, known top-level
  domains), ``structure`` (lengths, separators, count of words), ``lists``
  (gazetteers of mail providers, calling codes, card issuers, iban countries,
  street suffixes, given names), ``before`` and ``after`` (context words).
* Expectation-maximisation over the counts of vote patterns estimates, kind by
  kind, the share of true spans and each labeler's reliability (how it votes on
  true and on false spans), as in Dawid and Skene's model.
* The posteriors train the final span classifier, a logistic regression over
  features of the span itself and its context (which cue words stand near).
  Candidates that it accepts and that overlap neither a base span nor an accepted
  one of a kind listed before are added under their own kinds.

What reaches the driver is one row per combination of kind, votes and features
(a fixed, small number of values), never a span.  Everything per span is a
column expression: no Python runs on the executors.

Scale: one scan of the texts, whose spans are cut to the shared folder (they
are few); no shuffle but the count of vote patterns.

Defined cases: null and empty texts have no span; very long texts are read
whole; repeated rows are judged alike; ids may be null or repeated; without
candidates nothing is trained or added; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spans import SPAN, spans
from .tables import cut, table

BASE = ("email", "ip", "card", "phone")
#: Kinds of added spans, in output order after the base kinds.
WEAK = ("email_spelled", "iban", "ssn", "street", "person", "card_grouped", "number_grouped")
KINDS = BASE + WEAK

# The contract's patterns, with possessive groups and run starts (same matches).
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?+[0-9]){15,}+"  # shorter runs fail anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SPELLED = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?+[(\[{]at[)\]}]\x20?+[A-Za-z0-9-]++"
           r"(?:(?:\.|\x20?+[(\[{]dot[)\]}]\x20?+)[A-Za-z0-9-]++)++")
GROUPED = r"(?<![A-Za-z0-9.+-])\(?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,18}+(?![A-Za-z0-9-])"

IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}){2,7}+(?:\x20?+[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
SSN = r"(?<![A-Za-z0-9.+-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![A-Za-z0-9-])"
CARD_GROUPED = r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"
_CAP = r"[A-Z][a-z]{1,20}+"
SUFFIXES = ("Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Dr|Boulevard|Blvd|Court|Ct|Square|Place|Way|Terrace|Close|"
            "Crescent|Parkway|Highway|Row|Alley")
STREET = (rf"(?<![A-Za-z0-9.,-])[0-9]{{1,5}}+(?:(?:\x20{_CAP}){{1,3}}?\x20(?:{SUFFIXES})\b"
          rf"|(?:\x20{_CAP}){{2,3}}+)")
PERSON = (r"(?=[A-Z])(?<=\b(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20|\b(?i:name is|named|dear|regards,|signed by|author:?|patient|contact|"
          rf"customer|employee)\x20){_CAP}(?:\x20{_CAP}){{0,2}}+")

# Gazetteers.
TLDS = "com|net|org|edu|gov|int|info|biz|io|de|fr|es|it|nl|be|at|ch|pl|se|no|dk|fi|pt|uk|ie|us|ca|au|nz|jp|cn|in|br|mx|ru|eu"
PROVIDERS = r"@(gmail|yahoo|outlook|hotmail|icloud|aol|gmx|web|proton|protonmail|mail|email|inbox|post|live|msn|yandex)\."
UNREAL = r"^(no-?reply|do-?not-?reply|test|user|username|foo|someone)@|@(localhost|test|invalid|domain)\b"
CALLING = (r"^\+(1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|"
           r"81|82|84|86|90|91|92|93|94|95|98|21[1-8]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|35[0-9]|37[0-9]|38[0-9]|42[013]|"
           r"50[0-9]|59[0-9]|85[0-6]|88[06]|96[0-8]|97[0-7]|99[2-68])")
AREAS = r"^\(?(555|800|888|877|866|0[1-9])|[() .-]555[) .-]"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|64|65|35|62)"
IBAN_SIZES = {"AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
              "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27,
              "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
              "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26}
NAMES = ("James|John|Robert|Michael|William|David|Richard|Joseph|Thomas|Charles|Mary|Patricia|Jennifer|Linda|Elizabeth|"
         "Barbara|Susan|Jessica|Sarah|Karen|Daniel|Matthew|Anthony|Mark|Paul|Steven|Andrew|Peter|George|Edward|Anna|"
         "Emma|Laura|Julia|Maria|Marie|Sophie|Alice|Jane|Jack|Harry|Oliver|Lucas|Hans|Karl|Klaus|Jean|Pierre|Carlos|"
         "Juan|Jose|Ana|Carmen|Ali|Omar|Fatima|Wei|Raj|Priya|Ivan|Olga|Nina|Eva|Max|Ben|Sam|Tom|Kate|Helen|Ruth|Alan")
NO_NAMES = ("The|This|That|These|Support|Customer|Service|Sales|Team|Office|Department|Sir|Madam|All|Our|Us|Friends|"
            "January|February|March|April|June|July|August|September|October|November|December|Monday|Tuesday|"
            "Wednesday|Thursday|Friday|Saturday|Sunday|Street|Road|City|University|Company|Figure|Table|Section")

# Cue words by group; a feature says which group stands nearest the span's kinds.
CUES = {"reach": r"(?i)\b(call|phone|tel|telephone|mobile|fax|mail|email|contact|reach|write)\b",
        "money": r"(?i)\b(card|visa|mastercard|iban|bank|account|payment|pay|transfer)\b",
        "person": r"(?i)\b(ssn|social|security|name|named|mr|mrs|ms|dr|dear|patient|employee|born)\b\.?",
        "place": r"(?i)\b(address|live|lives|living|located|ship|deliver|visit|home|office|resides)\b",
        "host": r"(?i)\b(ip|host|server|gateway|login|from)\b"}
BAD_WORDS = (r"(?i)\b(version|license|licence|isbn|page|pages|figure|table|section|chapter|token|secret|password|"
             r"commit|hash|serial|build|release|order|part|model|sample)\b")
OWN_CUES = {"email": "reach", "ip": "host", "card": "money", "phone": "reach", "email_spelled": "reach",
            "iban": "money", "ssn": "person", "street": "place", "person": "person", "card_grouped": "money",
            "number_grouped": "reach"}
AFTER = {"street": r"^,?\x20[A-Z][a-z]+|^,?\x20[0-9]{5}\b", "person": r"^[,.\n]|^\x20(said|wrote|lives|is|was|has)\b"}

LABELERS = ("check", "structure", "lists", "before", "after")
ROUNDS = 50


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(F.reverse(digits), i, F.lit(1)).cast("int")).otherwise(
            F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                  F.substring(F.reverse(digits), i, F.lit(1)).cast("int"))))
    return (F.length(digits) > 0) & (total % 10 == 0)


def _base(text: Column) -> dict[str, Column]:
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    digit_run = text.rlike("[0-9]")
    return {
        "email": spans(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(spans(text, IP, digit_run & text.rlike(r"[0-9]\.[0-9]")),
                       lambda x: x["m"].rlike(rf"^{octet}(?:\.{octet}){{3}}$")),
        "card": F.filter(spans(text, CARD, digit_run), lambda x: F.length(_digits(x["m"])).between(16, 19)
                         & luhn(_digits(x["m"]))),
        "phone": F.filter(spans(text, PHONE, F.contains(text, F.lit("+"))),
                          lambda x: F.length(_digits(x["m"])).between(8, 15)),
    }


def _weak(text: Column) -> dict[str, Column]:
    return {"email_spelled": spans(text, SPELLED, text.rlike(r"[(\[{]at[)\]}]")),
            "iban": spans(text, IBAN, text.rlike(r"[A-Z]{2}[0-9]{2}")),
            "ssn": spans(text, SSN, text.rlike(r"[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}")),
            "street": spans(text, STREET, text.rlike(r"[0-9]\x20[A-Z][a-z]")),
            "person": spans(text, PERSON, text.rlike(PERSON)),
            "card_grouped": spans(text, CARD_GROUPED, text.rlike(r"[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}")),
            "number_grouped": spans(text, GROUPED, text.rlike(r"[0-9](?:[\x20().-]{0,2}+[0-9]){6}"))}


def mod97(iban: Column) -> Column:
    """Whether letters and digits pass the check of an iban."""
    turned = F.concat(F.substring(iban, 5, 64), F.left(iban, F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(turned, i, F.lit(1))) - 1
        return (acc * F.when(v < 10, 10).otherwise(100) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _own_votes(kind: str, m: Column, digits: Column, n: Column) -> tuple[Column, Column, Column]:
    """The votes of ``check``, ``structure`` and ``lists`` on a span of a kind."""
    if kind.startswith("email"):
        plain = F.lower(F.regexp_replace(F.regexp_replace(m, r"\x20?[(\[{]at[)\]}]\x20?", "@"),
                                         r"\x20?[(\[{]dot[)\]}]\x20?", "."))
        known = plain.rlike(rf"\.({TLDS})$")
        local = F.regexp_extract(plain, "^[^@]*", 0)
        real = local.rlike("[a-z]") & (F.length(local) <= 64)
        return (_vote(known, ~known), _vote(real, ~real),
                _vote(plain.rlike(PROVIDERS) & ~plain.rlike(UNREAL), plain.rlike(UNREAL)))
    if kind == "ip":
        usable = ~m.rlike(r"^0*(0|127|255|22[4-9]|2[34][0-9])\.")
        wide = m.rlike(r"(^|\.)[0-9]{2,3}\.[0-9.]*[0-9]{2,3}")
        return (_vote(usable, ~usable), _vote(wide, ~wide),
                _vote(m.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)"), m.rlike(r"^[0-9](\.[0-9]){3}$")))
    if kind.startswith("card"):
        issued = digits.rlike(ISSUERS)
        return _vote(luhn(digits), ~luhn(digits)), _vote(n == 16, n > 16), _vote(issued, ~issued)
    if kind == "iban":
        plain = F.regexp_replace(m, "\x20", "")
        size = F.get(F.array(*[F.lit(v) for v in IBAN_SIZES.values()]),
                     F.array_position(F.array(*[F.lit(k) for k in IBAN_SIZES]), F.left(plain, F.lit(2)))
                     .cast("int") - 1)
        fits = F.coalesce(F.length(plain) == size, F.lit(False))
        return _vote(mod97(plain), ~mod97(plain)), _vote(fits, ~fits), _vote(size.isNotNull(), size.isNull())
    if kind == "ssn":
        issued = ~(digits.rlike("^(000|666|9)") | digits.rlike("^...00") | digits.rlike("0000$"))
        dashes = m.rlike("^[0-9]{3}-[0-9]{2}-")
        return (_vote(issued, ~issued), _vote(dashes, m.rlike("-") & ~dashes),
                _vote(F.lit(False), digits.isin("078051120", "219099999", "123456789", "111111111")))
    if kind == "street":
        year = m.rlike(r"^(19|20)[0-9]{2}\x20")
        ends = m.rlike(rf"\x20({SUFFIXES})$")
        return _vote(~year & (n <= 4), year), _vote(ends, ~ends), _vote(ends, m.rlike(rf"\x20({NO_NAMES})\b") & ~ends)
    if kind == "person":
        words = F.size(F.split(m, "\x20"))
        no_name = m.rlike(rf"\b({NO_NAMES})\b")
        return _vote(~no_name & (words > 1), no_name), _vote(words.isin(2, 3), words == 1), \
            _vote(m.rlike(rf"^({NAMES})\b"), no_name)
    # phone, number_grouped
    parted = m.rlike(r"[0-9][\x20().-]+[0-9]+[\x20().-]+[0-9]")
    return (_vote(n.between(9, 12), (n < 8) | (n > 15)), _vote(parted, ~parted),
            _vote(m.rlike(CALLING) | m.rlike(AREAS), m.rlike(r"^(19|20)[0-9]{2}[.-][0-9]{2}")))


def _judged(kind: str, places: Column) -> Column:
    """Every span of a kind with its votes and features, as small integers."""
    def judge(x: Column) -> Column:
        digits = _digits(x["m"])
        n = F.length(digits)
        check, structure, lists = _own_votes(kind, x["m"], digits, n)
        bad = x["before"].rlike(BAD_WORDS)
        own = x["before"].rlike(CUES[OWN_CUES[kind]])
        votes = {"check": check, "structure": structure, "lists": lists, "before": _vote(own & ~bad, bad),
                 "after": _vote(x["after"].rlike(AFTER.get(kind, CUES[OWN_CUES[kind]])), x["after"].rlike(BAD_WORDS))}
        k = KINDS.index(kind)
        cue = F.lit(0)
        for i, words in enumerate(CUES.values()):
            cue = F.when(x["before"].rlike(words), i + 1).otherwise(cue)
        features = {
            "kind": F.lit(k), "size": F.least(n, F.lit(20)),
            "marks": F.least(F.length(F.regexp_replace(x["m"], "[A-Za-z0-9]", "")), F.lit(5)),
            "cue": cue, "bad": bad.cast("int"),
            **{f: 3 * k + 1 + votes[f] for f in ("check", "structure", "lists", "after")},
        }
        return F.struct(x["s"].alias("s"), x["e"].alias("e"),
                        *[v.cast("int").alias(f) for f, v in votes.items()],
                        *[v.cast("int").alias("f_" + f) for f, v in features.items()])
    return F.transform(F.coalesce(places, F.array().cast(SPAN)), judge)


FEATURES = {"kind": len(KINDS), "size": 21, "marks": 6, "cue": len(CUES) + 1, "bad": 2,
            **{f: 3 * len(KINDS) for f in ("check", "structure", "lists", "after")}}


def expectation_maximisation(votes: np.ndarray, weight: np.ndarray, start: np.ndarray,
                             rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each vote pattern, the labelers' vote shares on false and
    true spans (2, labelers, 3 votes), and the share of true spans."""
    post = start.astype(float)
    n, m = votes.shape
    shares = np.zeros((2, m, 3))
    prior = 0.5
    for _ in range(rounds):
        prior = float(np.clip((post * weight).sum() / weight.sum(), 0.02, 0.98))
        for side, p in enumerate((1 - post, post)):
            for j in range(m):
                for v in range(3):
                    shares[side, j, v] = (p * weight * (votes[:, j] == v - 1)).sum() + 1
        shares /= shares.sum(axis=2, keepdims=True)
        logs = [np.log(q) + sum(np.log(shares[side, j, votes[:, j] + 1]) for j in range(m))
                for side, q in enumerate((1 - prior, prior))]
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return post, shares, prior


def train(judged: DataFrame) -> dict[str, list[float]]:
    """Weights per feature value, learned from all spans of ``judged``."""
    names = [*LABELERS, *["f_" + f for f in FEATURES]]
    rows = (judged.select(F.explode("judged").alias("x")).groupBy(*[F.col(f"x.{n}").alias(n) for n in names])
            .agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect())  # fixed value ranges: bounded
    weights = {f: [0.0] * k for f, k in FEATURES.items()}
    if not rows:
        return weights
    votes = np.array([[r[x] for x in LABELERS] for r in rows])
    cells = np.array([[r["f_" + f] for f in FEATURES] for r in rows])
    n = np.array([r["n"] for r in rows], dtype=float)
    start = 1 / (1 + np.exp(-2.0 * votes.sum(axis=1) + 1.0))
    post = np.zeros(len(rows))
    for k in np.unique(cells[:, 0]):  # reliabilities differ between kinds
        of = cells[:, 0] == k
        post[of] = expectation_maximisation(votes[of], n[of], start[of])[0]
    # logistic regression on one-hot features, by gradient steps on the pattern counts
    offsets = np.cumsum([0, *itertools.islice(FEATURES.values(), len(FEATURES) - 1)])
    x = np.zeros((len(rows), sum(FEATURES.values())))
    x[np.arange(len(rows))[:, None], cells + offsets[None, :]] = 1
    w = np.zeros(x.shape[1])
    share = n / n.sum()
    for _ in range(400):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ ((p - post) * share) + 1e-3 * w)
    for (f, k), o in zip(FEATURES.items(), offsets):
        weights[f] = [float(v) for v in w[o: o + k]]
    return weights


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, the places of the base spans, and ``judged``: every candidate with
    its place, votes and features."""
    text = F.col("text")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = found.withColumns({**_base(text), **_weak(text)}).drop("text")
    judged = {k: _judged(k, F.col(k)) for k in KINDS}
    return found.select("doc_id", *[F.transform(
        F.coalesce(F.col(k), F.array().cast(SPAN)), lambda x: F.struct(x["s"], x["e"])).alias(k) for k in BASE],
        F.concat(*judged.values()).alias("judged"))


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the four base span lists, and ``added``
    (kind:start:end of accepted weak spans, by kind then start)."""
    found = cut(candidates(docs))
    weights = train(found)
    every = F.concat(*[F.col(k) for k in BASE])

    def accepted(x: Column) -> Column:
        score = sum((F.get(F.array(*[F.lit(v) for v in weights[f]]), x["f_" + f]) for f in FEATURES), F.lit(0.0))
        return ((x["f_kind"] >= len(BASE)) & (score > 0)
                & ~F.exists(every, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))

    found = found.withColumn("_taken", F.filter("judged", accepted))
    names = F.array(*[F.lit(k) for k in KINDS])
    added = F.transform(F.filter("_taken", lambda x: ~F.exists("_taken", lambda y: (
        y["f_kind"] < x["f_kind"]) & (y["s"] < x["e"]) & (x["s"] < y["e"]))), lambda x: F.concat_ws(
            ":", F.get(names, x["f_kind"]), x["s"].cast("string"), x["e"].cast("string")))
    return found.select("doc_id", *BASE, added.alias("added"))


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.concat(*[named_pairs(k) for k in BASE])
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, "added"), ",").alias("spans"))


def named_pairs(kind: str) -> Column:
    return F.transform(F.col(kind), lambda x: F.concat_ws(
        ":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))
