"""PII surrogates: every detected entity gets a keyed replacement of its own kind.

Entities: e-mail and IPv4 addresses, IBANs, payment card, social security and
phone numbers, names after a form of address, and each such name wherever else
its document has it as a word.  Replacements keep the kind and the format
(separators, case, length, dots and digits of an address, country code,
check-digit validity, the form of address, its gender, and the name's script).

One entity has one canonical form (digits only, lower case) however it is
written, and one surrogate everywhere, so references stay together; a family
name keeps its surrogate with and without the given name, and a mail domain
has one for all its mailboxes.  Surrogates derive from a keyed hash.  They are
then checked: one that two entities of a kind share, or that is itself an
entity of the input, is drawn again in a further round until all are distinct;
names, mailboxes and domains grow longer with the rounds, so there are always
enough.  The entity table is distinct values only, so an entity in a third of
all rows is one row there, and its occurrences meet it in a join that adaptive
execution can split.

All steps are DataFrame functions.  A cheap test for digits, ``@`` and forms
of address leaves most texts out of the search.  Rows with an entity are
written once to the shared folder with a row number, so repeated rows stay
apart.

Cases: null and empty texts stay as they are; texts without an entity are
unchanged; the work on a text grows in proportion to its entities, however
many they are; more entities of a kind of fixed length than it has values end
in an error after ``ROUNDS`` rounds; other columns are untouched, whatever
their names (an input column ``n_entities`` is replaced); an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow import session
from civicflow.llm.textmap import others, quoted

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_WORD = r"(?:\p{IsLatin}|\p{IsCyrillic}|\p{IsGreek})"
# fixed values: forms of address and the gender they tell
MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "Г-н", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Госпожа", "Г-жа", "Κυρία")
_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
_NAME = rf"\p{{Lu}}\p{{L}}+(?:[-’']\p{{Lu}}\p{{L}}+)?"
KINDS = {
    # possessive runs after a look-behind: each run is read once, so a long one costs its length
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)*\.[A-Za-z]{2,}+",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![A-Za-z0-9]|\.\d)",
    "iban": r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w\-])\d{4}(?:(?:[ \-]?\d{4}){3}|[ \-]?\d{6}[ \-]?\d{5})(?![\w])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\) ?|\d{3}[.\-])\d{3}[ .\-]?\d{4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\w)",
    "name": rf"(?<![\p{{L}}\d])(?:{_TITLES})\.? {_NAME}(?: {_NAME})?",
}
PATTERN = "|".join(KINDS.values())
# in texts with a named person also every word that may be that name again
NAMES_PATTERN = rf"{PATTERN}|(?<![\p{{L}}\d]){_NAME}(?![\p{{L}}\d])"
# what every entity has one of
HINT = rf"[@0-9]|(?=[{''.join(sorted({t[0] for t in MALE + FEMALE}))}])(?<![\p{{L}}\d])(?:{_TITLES})\.? \p{{Lu}}"
# rounds of drawing before the values of a kind are held to be used up
ROUNDS = 200
_LETTERS = {"latin": ("b c d f g l m n p r s t v z".split(), "a e i o u".split()),
            "cyrillic": ("б в г д к л м н п р с т".split(), "а е и о у".split()),
            "greek": ("β γ δ κ λ μ ν π ρ σ τ φ".split(), "α ε ι ο υ".split())}
_ENDING = {"latin": {"m": "o", "f": "a", "n": "er"}, "cyrillic": {"m": "ей", "f": "ина", "n": "енко"},
           "greek": {"m": "ος", "f": "α", "n": "ου"}}


def _parts(raw: Column) -> Column:
    """An occurrence as (kind, text, canonical form) pieces; pieces of kind 'keep' stay.

    Names: address, given and family name.  Mail addresses: mailbox (one for each address) and domain.
    """
    digits = F.regexp_replace(raw, "[^0-9]", "")

    def piece(kind: Column, text: Column, canonical: Column) -> Column:
        return F.struct(kind.alias("kind"), text.alias("raw"), canonical.alias("canonical"))

    def one(kind: str) -> Column:
        return F.array(piece(F.lit(kind), raw, _canonical(F.lit(kind), raw)))

    mailbox, domain = F.substring_index(raw, "@", 1), F.substring_index(raw, "@", -1)
    mail = F.array(piece(F.lit("mailbox"), mailbox, F.lower(raw)), piece(F.lit("keep"), F.lit("@"), F.lit("@")),
                   piece(F.lit("domain"), domain, F.lower(domain)))
    tokens = F.regexp_extract_all(raw, F.lit(r"\s+|\S+"), F.lit(0))
    title = F.regexp_replace(F.element_at(tokens, 1), r"\.$", "")
    gender = F.when(title.isin(*MALE), "m").otherwise("f")

    def script(word: Column) -> Column:
        return (F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))

    def named(word: Column, i: Column) -> Column:
        kind = (F.when((i == 0) | (i % 2 == 1), F.lit("keep"))
                .when(i == F.size(tokens) - 1, F.concat(F.lit("family_"), script(word)))
                .otherwise(F.concat(F.lit("given_"), gender, F.lit("_"), script(word))))
        return piece(kind, word, F.lower(word))

    name = F.transform(tokens, named)
    return (F.when(raw.contains("@"), mail).when(raw.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), one("ip"))
            .when(raw.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]+$"), one("iban")).when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), one("ssn"))
            .when(raw.rlike(r"^\d{4}[ \-]?\d") & F.length(digits).isin(15, 16) & ~raw.startswith("+"), one("card"))
            .when(raw.rlike(r"^[+(\d]"), one("phone")).otherwise(name))


def _canonical(kind: Column, raw: Column) -> Column:
    return (F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(raw, "[^0-9]", ""))
            .when(kind == "iban", F.regexp_replace(raw, " ", "")).when(kind == "ip", raw).otherwise(F.lower(raw)))


def _luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn scheme over digits that a check digit will follow."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(F.filter(places, lambda p: p["d"].isNotNull()), F.lit(0),
                       lambda acc, p: acc + F.when(p["i"] % 2 == 0, F.when(p["d"] > 4, p["d"] * 2 - 9).otherwise(p["d"] * 2)).otherwise(p["d"]))


def _mod_97(text: Column) -> Column:
    """Remainder by 97 of letters and digits as one number, A-Z as 10 to 35."""
    values = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _draw(kind: Column, canonical: Column, key: str, turn: int) -> Column:
    """A surrogate in canonical form: the same kind and length, from a hash of key, kind, entity and round."""
    def stream(n: int) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, F.lit(f"{turn}.{n}")), 256)

    h = stream(0)

    def number(n: int, limit: int) -> Column:
        """0 .. limit - 1 from the n-th 12 hex digits of the streams."""
        return F.conv(F.substring(stream(n // 5 + 1), 1 + 12 * (n % 5), 12), 16, 10).cast("decimal(20,0)").cast("long") % limit

    digits = F.concat(*[F.lpad(number(i, 10 ** 9).cast("string"), 9, "0") for i in range(4)])
    length = F.length(canonical)
    national = F.least(length, F.lit(10))
    phone = F.concat(F.substring(canonical, F.lit(1), length - national), F.substring(digits, F.lit(1), national))
    body = F.concat(F.substring(canonical, 1, 1), F.substring(digits, F.lit(1), length - 2))
    check = (10 - _luhn_sum(body) % 10) % 10
    own = (10 - _luhn_sum(F.substring(canonical, F.lit(1), length - 1)) % 10) % 10
    valid = own == F.substring(canonical, -1, 1).cast("int")
    card = F.concat(body, F.when(valid, check).otherwise((check + 1 + F.conv(F.substring(h, 1, 4), 16, 10).cast("int") % 9) % 10).cast("string"))
    ip = F.concat_ws(".", (1 + number(0, 223)).cast("string"), *[number(i, 256).cast("string") for i in (1, 2)], (1 + number(3, 254)).cast("string"))
    country, account = F.substring(canonical, 1, 2), F.substring(canonical, F.lit(5), length - 4)
    pool = F.concat(stream(3), stream(4))
    account_new = F.array_join(F.transform(F.filter(F.split(account, ""), lambda c: c != ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, i + 1, F.lit(1))).otherwise(
            F.char(65 + F.conv(F.substring(pool, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % 26))), "")
    # 2 to 98: the one value that is valid, or another one
    sum_97 = 98 - _mod_97(F.concat(account_new, country, F.lit("00")))
    sound = _mod_97(F.concat(account, F.substring(canonical, 1, 4))) == 1
    other_97 = (sum_97 - 1 + F.conv(F.substring(h, 1, 6), 16, 10).cast("int") % 96) % 97 + 2
    iban = F.concat(country, F.lpad(F.when(sound, sum_97).otherwise(other_97).cast("string"), 2, "0"), account_new)

    def alike(text: Column) -> Column:
        """A letter for each letter and a digit for each digit, and a letter more every other round."""
        signs = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c, i: F.when(
            c.rlike("[0-9]"), F.char(48 + F.pmod(F.xxhash64(h, i), F.lit(10)))).when(
                c.rlike("[a-z]"), F.char(97 + F.pmod(F.xxhash64(h, i), F.lit(26)))).otherwise(c))
        more = [F.char(97 + F.pmod(F.xxhash64(h, F.lit(-1 - i)), F.lit(26))) for i in range(turn // 2)]
        return F.concat(*more, F.array_join(signs, ""))

    labels = F.split(canonical, r"\.")
    above = F.element_at(labels, -1)
    mailbox = alike(F.substring_index(canonical, "@", 1))
    domain = F.concat(alike(F.array_join(F.slice(labels, 1, F.size(labels) - 1), ".")), F.lit("."), above)

    def name(script: str, ending: str, syllables: int) -> Column:
        first, second = _LETTERS[script]
        return F.concat(*[x for i in range(syllables) for x in (
            F.element_at(F.array(*map(F.lit, first)), (number(2 * i, len(first)) + 1).cast("int")),
            F.element_at(F.array(*map(F.lit, second)), (number(2 * i + 1, len(second)) + 1).cast("int")))], F.lit(_ENDING[script][ending]))

    out = (F.when(kind == "mailbox", mailbox).when(kind == "domain", domain).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card)
           .when(kind == "ssn", F.substring(digits, 1, 9)).when(kind == "iban", iban))
    for script in _LETTERS:
        out = out.when(kind == f"family_{script}", name(script, "n", 4 + turn // 2))
        for gender in ("m", "f"):
            out = out.when(kind == f"given_{gender}_{script}", name(script, gender, 4 + turn // 2))
    return out


def _formatted(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate as ``raw`` was written: its separators and its case."""
    chars = F.split(raw, "")

    def digit(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(surrogate, place, F.lit(1))).otherwise(c)

    def sign(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), " ", ""))
        return F.when(c != " ", F.substring(surrogate, place, F.lit(1))).otherwise(c)

    upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    return (F.when(kind.isin("phone", "card", "ssn"), F.array_join(F.transform(chars, digit), ""))
            .when(kind == "iban", F.array_join(F.transform(chars, sign), "")).when(kind.isin("ip", "mailbox", "domain"), surrogate)
            .when(upper & (F.length(raw) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate)))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) of distinct (kind, canonical) rows, all surrogates of a kind distinct and none an entity.

    Each round settles the surrogates that one entity alone draws (of several
    that draw the same, the first in order); the others draw again.  A round
    leaves only collisions, a small share of a small share, so few are needed.
    """
    entities = entities.checkpoint()
    real = entities.select("kind", F.col("canonical").alias("surrogate"))
    settled, pending, turn = None, entities, 0
    while True:
        drawn = pending.withColumn("surrogate", _draw(F.col("kind"), F.col("canonical"), key, turn))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "surrogate")
        settled = (won if settled is None else settled.unionByName(won)).checkpoint()
        pending = entities.join(settled, ["kind", "canonical"], "left_anti").checkpoint()
        if pending.isEmpty():
            return settled
        turn += 1
        if turn == ROUNDS:
            raise ValueError("more entities of a kind than it has surrogates")


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with surrogates in ``text``, and n_entities, the number of entities replaced."""
    spark = docs.sparkSession
    carried = others(list(docs.columns), [text, "n_entities"])
    found = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)], quoted(text).cast("string").alias("t"))
    none = F.array().cast("array<string>")
    found = found.withColumn("e", F.when(F.col("t").rlike(HINT), F.regexp_extract_all("t", F.lit(PATTERN), F.lit(0))).otherwise(none))
    has = F.size(F.coalesce("e", none)) > 0
    # texts that name a person are searched again for the name alone
    named = F.exists("e", lambda raw: raw.rlike(rf"^(?:{_TITLES})\.? "))
    session.shared_dir(spark)
    folder = session.scratch(spark, "surrogates")
    (found.filter(has).withColumn("row", F.monotonically_increasing_id()).withColumn("named", named)
     .withColumn("e", F.when(F.col("named"), F.regexp_extract_all("t", F.lit(NAMES_PATTERN), F.lit(0))).otherwise(F.col("e")))
     .write.option("compression", "zstd").parquet(folder))
    marked = spark.read.parquet(folder)
    pieces = (marked.select("row", F.posexplode("e").alias("place", "whole"))
              .select("row", "place", F.posexplode(_parts(F.col("whole"))).alias("piece", "part"))
              .select("row", "place", "piece", "part.*"))
    # the names of a text behind a form of address; one that is also a family name is that
    known = (pieces.filter(F.col("kind").startswith("family_") | F.col("kind").startswith("given_"))
             .groupBy("row", "raw").agg(F.min("kind").alias("known")))
    uses = pieces.join(known, ["row", "raw"], "left").select(
        "row", "place", "piece", "raw", "canonical",
        # a word alone, not the form of address in front of a name
        F.when((F.col("kind") == "keep") & (F.col("piece") == 0), F.coalesce("known", "kind")).otherwise(F.col("kind")).alias("kind"))
    table = surrogate_table(uses.filter("kind <> 'keep'").select("kind", "canonical").distinct(), key)
    fixed = uses.join(table, ["kind", "canonical"], "left").select(
        "row", "place", "piece", (F.col("kind") != "keep").alias("changed"), F.when(F.col("kind") == "keep", F.col("raw"))
        .otherwise(_formatted(F.col("kind"), F.col("raw"), F.col("surrogate"))).alias("new"))
    # the pieces of one occurrence, then the occurrences of one text: bounded by the text
    per_place = fixed.groupBy("row", "place").agg(F.array_sort(F.collect_list(F.struct("piece", "new"))).alias("new"), F.max("changed").alias("changed"))
    per_doc = (per_place.select("row", "place", F.array_join(F.transform("new", lambda x: x["new"]), "").alias("new"), "changed")
               .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias("new"), F.count_if("changed").alias("n")))
    segments = F.when(F.col("named"), F.split("t", NAMES_PATTERN, -1)).otherwise(F.split("t", PATTERN, -1))
    # each text between two occurrences, then the occurrence; none behind the last one
    fills = F.zip_with(segments, F.col("new"), lambda s, x: F.concat(s, F.coalesce(x["new"], F.lit(""))))
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(carried)]
    done = marked.join(per_doc, "row").select(*columns, F.array_join(fills, "").alias(text), F.col("n").cast("long").alias("n_entities"))
    plain = found.filter(~has).select(*columns, F.col("t").alias(text), F.lit(0).cast("long").alias("n_entities"))
    return plain.unionByName(done)
