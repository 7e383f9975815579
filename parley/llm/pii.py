"""PII surrogates: detected entities get keyed, type-consistent replacements (native Spark only).

Detection is one regular expression over whole texts.  An entity is (type, normalised form): digits of
phone, card and social-security numbers (a phone number with its ``+``), lower-cased mail addresses, the value
behind a ``token = `` and so on.  The same entity gets the same surrogate in every document and every
spelling (coreference).

Numbers, keys and secrets are mapped by a keyed bijection of their format (:func:`permuted`, a Feistel network
over the characters with SHA-512 as round function): digits become digits and letters letters of the same case
and script, so entities of one format never share a surrogate.  What the format fixes stays: the country code of
a phone number, by the same parse in every spelling, the issuer digit and the Luhn remainder of a card, the first
characters of keys and account numbers, all separators.  Addresses and names are drawn from the digest: an address
is a valid address, a name follows the title's gender and keeps its script, spaces and hyphens.

Distinctness is checked over the whole corpus, in the form that is written: surrogates that two entities share, or
that equal a real entity, are drawn again with the next attempt, at most ``MOST_ATTEMPTS`` times.  A number format of
which more than a quarter is taken by real entities (say, 30,000 phone numbers of five digits) has too few others;
there the bijection alone holds: surrogates are distinct, but may be another real number of that format.  The
entities of a later attempt, few as they are, go to every task if there are at most ``MOST_HELD``; else the
texts that hold one are joined with them by digest, the most frequent texts without a shuffle.

Letters outside the alphabets below (other scripts in quoted secrets) are drawn, not permuted; the check holds for them, too.

Edge cases: null text stays null, text without entities is unchanged; empty and very long texts are treated whole;
repeated rows and null ids are treated each; an empty table gives an empty result; extra columns pass through
(internal ones begin with ``_p_``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import joined, let, written

KEY = "surrogate-key"  # default only: pass your own secret
MOST_ATTEMPTS, MOST_HELD, ROUNDS = 64, 10_000, 6

_FEMALE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία"
_MALE = r"Mr|Herr|Monsieur|Señor|Sr|Господин|Κύριος"
_GREETING = r"(?:Dear|Hello|Hallo|Liebe|Lieber|Bonjour|Chère|Cher|Hola|Querida|Querido|Regards|Sincerely)"
_SECRET = r"(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key|secret[_-]?key)"
#: type, pattern (no capturing groups), in order of preference
PATTERNS = [
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}"),
    ("key", r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])"),
    ("secret", r"(?<![\p{L}\p{N}])" + _SECRET + r"\s{0,3}[=:]\s{0,3}(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{8,})"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ipv6", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("ipv4", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![\p{L}0-9.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![\p{L}0-9])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"),
    ("card", r"(?<![0-9.])(?:[0-9]{4}[ -]){3}[0-9]{1,7}(?![0-9])|(?<![0-9.])[0-9]{13,19}(?![0-9])"),
    ("name", r"(?<!\p{L})(?:" + _FEMALE + "|" + _MALE + r")\.? \p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+){0,2}|(?<!\p{L})" + _GREETING + r",?\s(?!(?:" + _FEMALE + "|" + _MALE + r")\b)\p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+){1,2}"),
]
MASTER = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: Any entity holds one of these; texts without skip the costly pattern.
HINT = r"[0-9@=:]|A[KS]IA|gh[pousr]_|sk-|(?:" + _FEMALE + "|" + _MALE + r")\.? \p{Lu}|" + _GREETING + r",?\s\p{Lu}"
#: fixed values: country calling codes of one and two digits; all others have three
_CALLING = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CYR, _GREEK = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"
#: pattern of a character, what it is drawn from
ALPHABETS = [(r"[0-9]", "0123456789"), (r"[a-z]", _LOWER), (r"[A-Z]", _UPPER), (r"\p{IsCyrillic}", _CYR),
             (r"\p{IsGreek}", _GREEK), (r"\p{Ll}", _LOWER), (r"\p{Lu}", _UPPER), (r"\p{L}", _LOWER)]


def kind_of(entity: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed(PATTERNS[:-1]):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def split_entity(entity: Column, kind: Column) -> Column:
    """struct(prefix, core, suffix): only the core is private."""
    secret, name = r"^(.*?[=:]\s{0,3}[\"']?)(.*?)([\"']?)$", r"^(\p{L}+[.,]?\s)(.*)$"
    whole = F.struct(F.lit("").alias("prefix"), entity.alias("core"), F.lit("").alias("suffix"))
    return (F.when(kind == "secret", F.struct(F.regexp_extract(entity, secret, 1).alias("prefix"), F.regexp_extract(entity, secret, 2).alias("core"), F.regexp_extract(entity, secret, 3).alias("suffix")))
            .when(kind == "name", F.struct(F.regexp_extract(entity, name, 1).alias("prefix"), F.regexp_extract(entity, name, 2).alias("core"), F.lit("").alias("suffix")))
            .otherwise(whole))


def normal(kind: Column, core: Column, prefix: Column) -> Column:
    """What two mentions of one entity share; a name carries the gender of its title."""
    female = F.when(prefix.rlike(f"^(?:{_FEMALE}|Liebe\\b|Chère|Querida)"), F.lit("f ")).otherwise(F.lit("m "))
    return (F.when(kind == "email", F.lower(core)).when(kind.isin("card", "ssn"), F.regexp_replace(core, "[^0-9]", ""))
            .when(kind == "phone", F.concat(F.when(core.startswith("+"), "+").otherwise(""), F.regexp_replace(core, "[^0-9]", "")))
            .when(kind == "iban", F.regexp_replace(core, " ", "")).when(kind == "ipv6", F.lower(core))
            .when(kind == "name", F.concat(female, core)).otherwise(core))


def _number(digest: Column, i: Column) -> Column:
    """The i-th (0-based, cyclic) byte of a hex digest."""
    return F.conv(F.substring(digest, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _drawn(char: Column, digest: Column, i: Column, alphabets=None) -> Column:
    """A character of the same class as ``char``; others stay."""
    out = char
    for pattern, letters in reversed(alphabets or ALPHABETS):
        one = lambda letters: F.substring(F.lit(letters), _number(digest, i) % len(letters) + 1, F.lit(1))
        drawn = one(letters)
        if letters in (_CYR, _GREEK):
            drawn = F.when(F.upper(char) == char, F.upper(drawn)).otherwise(drawn)
        out = F.when(char.rlike(pattern), drawn).otherwise(out)
    return out


def _by_char(text: Column, digest: Column, skip: int = 0, alphabets=None) -> Column:
    """``text`` with every character after the first ``skip`` drawn anew within its class."""
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
                        lambda i: let(F.substring(text, i, F.lit(1)), lambda c: F.when(i <= skip, c).otherwise(_drawn(c, digest, i, alphabets))))
    return F.array_join(chars, "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10."""
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: let(
        F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, F.lit(2)).otherwise(F.lit(1)), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10


def _name(core: Column, digest: Column, female: Column, attempt: Column) -> Column:
    """As many capitalised words of drawn syllables as ``core`` has, in its script.

    The last word has a syllable more for each later attempt, so that no number of names uses them up.
    """
    def word(given: Column, last: Column, w: Column, j: Column) -> Column:
        def built(consonants, vowels, end_f, end_m):
            pair = lambda k: F.concat(F.substring(F.lit(consonants), _number(digest, j * 8 + k) % len(consonants) + 1, F.lit(1)), F.substring(F.lit(vowels), _number(digest, j * 8 + k + 1) % len(vowels) + 1, F.lit(1)))
            end = F.when(given & female, F.lit(end_f)).otherwise(F.lit(end_m))
            more = F.when(last & (attempt > 0), F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(attempt, F.lit(1))), lambda a: pair(a * 2 + 6)), "")).otherwise(F.lit(""))
            return F.initcap(F.concat(pair(0), pair(2), more, F.substring(F.lit(consonants), _number(digest, j * 8 + 5) % len(consonants) + 1, F.lit(1)), end))
        return (F.when(w.rlike(r"\p{IsCyrillic}"), built("бвгдзклмнпрст", "аеиоу", "ина", "ин"))
                .when(w.rlike(r"\p{IsGreek}"), built("βγδζκλμνπρστ", "αειου", "ίνα", "ινος")).otherwise(built("bdfgklmnprstv", "aeiou", "ina", "en")))
    words, between = F.split(core, "[ -]"), F.regexp_extract_all(core, F.lit("[ -]"), F.lit(0))
    return F.array_join(F.transform(words, lambda w, j: F.concat(word((j == 0) & (F.size(words) > 1) | (F.size(words) == 1) & female, j == F.size(words) - 1, w, j),
                                                                 F.coalesce(F.get(between, j), F.lit("")))), "")


def _shifted(text: Column, digest: Column, hexed: Column) -> Column:
    """Every character moved on within its alphabet by a byte of the digest; reversible, given the digest."""
    def moved(c: Column, i: Column) -> Column:
        out = F.when(c.rlike(r"\p{L}"), F.substring(F.lit(_LOWER), _number(digest, i) % len(_LOWER) + 1, F.lit(1))).otherwise(c)
        for letters in (_UPPER, _LOWER, _CYR, _CYR.upper(), _GREEK, _GREEK.upper(), "0123456789"):
            whole = F.when(hexed, F.lit(letters[:6])).otherwise(F.lit(letters)) if letters in (_LOWER, _UPPER) else F.lit(letters)
            place = F.call_function("instr", whole, c)
            out = F.when(place > 0, F.substring(whole, (place - 1 + _number(digest, i)) % F.length(whole) + 1, F.lit(1))).otherwise(out)
        return out

    chars = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: let(F.substring(text, i, F.lit(1)), lambda c: moved(c, i)))
    return F.when(F.length(text) > 0, F.array_join(chars, "")).otherwise(text)


def permuted(text: Column, seed: Column, hexed: Column) -> Column:
    """A keyed bijection of the texts with the same class (digit, case, script) at every place.

    A Feistel network: in turn each half is shifted by a digest of the other one, so every round can be undone.
    """
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, F.length(text)).alias("b"))

    def turn(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        moving, other = F.when(even, s["a"]).otherwise(s["b"]), F.when(even, s["b"]).otherwise(s["a"])
        return let(_shifted(moving, F.sha2(F.concat_ws("|", seed, r.cast("string"), other), 512), hexed), lambda x: F.struct(
            F.when(even, x).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(x).alias("b")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _fixed(kind: Column, norm: Column) -> Column:
    """How many characters in front a format fixes."""
    return (F.when(kind == "phone", F.length(F.regexp_extract(norm, rf"^(\+(?:{_CALLING})(?=.))", 1))).when(kind == "card", 1).when(kind == "iban", 2)
            .when((kind == "key") & norm.rlike("^(?:A[KS]IA|gh)"), 4).when(kind == "key", 3).otherwise(0))


def drawn(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a normalised entity."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"))
    hexed = (kind == "ipv6") | (kind == "secret") & norm.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")

    def mapped(fixed: Column) -> Column:
        end = F.when(kind == "card", 1).otherwise(0)
        head, body = F.substring(norm, F.lit(1), fixed), F.substring(norm, fixed + 1, F.length(norm) - fixed - end)
        whole = F.concat(head, permuted(body, F.concat_ws("|", seed, head), hexed))
        return F.when(kind == "card", let(whole, lambda w: F.concat(w, F.pmod(_luhn(norm) - _luhn(F.concat(w, F.lit("0"))), F.lit(10)).cast("string")))).otherwise(whole)

    def made(digest: Column) -> Column:
        domain = F.concat(F.translate(F.substring(digest, 100, 20), "0123456789", "ghijklmnop"), F.lit(".example."),
                          F.when(norm.rlike(r"\.(?:com|net|org)$"), F.regexp_extract(norm, r"([a-z]+)$", 1)).otherwise(F.lit("com")))
        octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(digest, i) % 254 + 1).cast("string")), ".")
        return (F.when(kind == "email", F.concat(_by_char(F.regexp_extract(norm, "^(.*)@", 1), digest), F.lit("@"), domain))
                .when(kind == "ipv4", octets)
                .otherwise(_name(F.substring(norm, F.lit(3), F.length(norm)), digest, norm.startswith("f "), attempt)))

    return F.when(kind.isin("email", "ipv4", "name"), let(F.sha2(F.concat_ws("|", seed, norm), 512), made)).otherwise(let(_fixed(kind, norm), mapped))


def worn(kind: Column, core: Column, surrogate: Column) -> Column:
    """The surrogate in the written form of the mention, with its separators."""
    nth = lambda i: F.length(F.regexp_replace(F.substring(core, F.lit(1), i), "[^0-9A-Za-z]", ""))
    placed = let(F.regexp_replace(surrogate, "[^0-9A-Za-z]", ""), lambda signs: F.array_join(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(core), F.lit(1))), lambda i: let(
            F.substring(core, i, F.lit(1)), lambda c: F.when(c.rlike("[0-9A-Za-z]"), F.substring(signs, nth(i), F.lit(1))).otherwise(c))), ""))
    return F.when(kind.isin("phone", "card", "ssn", "iban"), placed).otherwise(surrogate)


def entities(text: Column) -> Column:
    """The entities of a text in order."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(MASTER), F.lit(0)))


def _replacement(entity: Column, key: str, later: Column) -> Column:
    """What stands for one mention; ``later`` maps "type|norm" to surrogates of later attempts."""
    def made(kind):
        return let(split_entity(entity, kind), lambda p: let(normal(kind, p["core"], p["prefix"]), lambda norm: let(
            F.coalesce(F.try_element_at(later, F.concat_ws("|", kind, norm)), drawn(kind, norm, F.lit(0), key)),
            lambda surrogate: F.concat(p["prefix"], worn(kind, p["core"], surrogate), p["suffix"]))))
    return let(kind_of(entity), made)


def entity_table(documents: DataFrame) -> DataFrame:
    """(kind, norm) of every distinct entity of the corpus."""
    found = documents.select(F.explode(entities(F.col("text"))).alias("e"))
    parts = found.select("e", kind_of(F.col("e")).alias("kind")).select("kind", split_entity(F.col("e"), F.col("kind")).alias("p"))
    return parts.select("kind", normal(F.col("kind"), F.col("p.core"), F.col("p.prefix")).alias("norm")).distinct()


def _crowded(table: DataFrame) -> DataFrame:
    """Number formats (kind, head, n_chars) of which real entities take more than a quarter."""
    end = F.when(F.col("kind") == "card", 1).otherwise(0)
    formats = table.where(F.col("kind").isin("phone", "ssn", "card")).groupBy("kind", "head", "n_chars").agg(F.count("*").alias("n"))
    return formats.where(4 * F.col("n") > F.pow(F.lit(10.0), F.col("n_chars") - F.length("head") - end)).select("kind", "head", "n_chars")


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt, surrogate), distinct within a kind and from every real entity.

    Only formats that real entities crowd (see above) may hold a surrogate that is real, too.
    """
    kind, norm = F.col("kind"), F.col("norm")
    draw = lambda df: df.withColumn("surrogate", drawn(kind, norm, F.col("attempt"), key))
    head = F.substring(norm, F.lit(1), _fixed(kind, norm))
    first = written(draw(found.withColumn("attempt", F.lit(0))).withColumns({"head": head, "n_chars": F.length(norm)}), "surrogates")
    crowded = _crowded(first)
    same = ["kind", "head", "n_chars"]
    settled = first.join(crowded, same, "left_semi").drop("head", "n_chars")
    table = first.join(crowded, same, "left_anti").drop("head", "n_chars")
    bare = F.when(kind == "name", F.expr("substring(norm, 3)")).otherwise(norm)  # without the gender
    real = first.select("kind", bare.alias("surrogate")).distinct()
    for _ in range(MOST_ATTEMPTS):
        winner = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n")).where("n > 1")
        lost = (table.join(winner, ["kind", "surrogate"]).where(F.struct("attempt", "norm") != F.col("first")).select("kind", "norm")
                .unionByName(table.join(real, ["kind", "surrogate"], "left_semi").select("kind", "norm"))).distinct()
        lost = written(lost, "clashes")
        if lost.isEmpty():
            return table.unionByName(settled)
        again = draw(table.join(lost, ["kind", "norm"], "left_semi").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        table = written(table.join(lost, ["kind", "norm"], "left_anti").unionByName(again.select(table.columns)), "surrogates")
    raise RuntimeError(f"surrogates still clash after {MOST_ATTEMPTS} attempts")


def replace(documents: DataFrame, key: str = KEY) -> DataFrame:
    """``documents`` with surrogates in ``text`` and, if there is one, ``n_chars`` set anew."""
    columns = documents.columns
    out = with_surrogates(documents, key)
    named = [F.col("_p_new").alias("text") if c == "text" else F.length("_p_new").cast(documents.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns]
    return out.select(*named)


def with_surrogates(documents: DataFrame, key: str = KEY) -> DataFrame:
    """``documents`` with ``_p_new`` (the replaced text) and ``_p_n`` (entities replaced)."""
    later = surrogates(entity_table(documents), key).where("attempt > 0")
    later = written(later.select(F.concat_ws("|", "kind", "norm").alias("entity"), "surrogate"), "later-surrogates")
    if later.count() <= MOST_HELD:
        held = later.agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("m")).scalar()
        rows = documents.withColumn("_p_later", held)
    else:
        # only texts that hold such an entity need its later surrogate; equal texts need the same
        mentions = documents.select(F.unhex(F.md5("text")).alias("_p_key"), "text").select("_p_key", F.explode(entities(F.col("text"))).alias("e"))
        parts = mentions.select("_p_key", "e", kind_of(F.col("e")).alias("kind")).select("_p_key", "kind", split_entity(F.col("e"), F.col("kind")).alias("p"))
        named = parts.select("_p_key", F.concat_ws("|", "kind", normal(F.col("kind"), F.col("p.core"), F.col("p.prefix"))).alias("entity")).distinct()
        # a text has at most as many entries as entities
        maps = joined(named, later, "entity").where("surrogate is not null").groupBy("_p_key").agg(
            F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("_p_later"))
        rows = joined(documents.withColumn("_p_key", F.unhex(F.md5("text"))), written(maps, "later-by-text"), "_p_key").drop("_p_key")
    rows = rows.withColumn("_p_ents", entities(F.col("text")))

    def assembled(pieces):
        return F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(F.col("_p_new_ents"), i), F.lit("")))), "")
    rows = rows.withColumn("_p_new_ents", F.transform("_p_ents", lambda e: _replacement(e, key, F.col("_p_later"))))
    some = F.coalesce(F.size("_p_ents"), F.lit(0)) > 0
    return (rows.withColumn("_p_new", F.when(some, let(F.split("text", MASTER), assembled)).otherwise(F.col("text")))
            .withColumn("_p_n", F.when(some, F.size("_p_ents")).otherwise(F.lit(0))).drop("_p_ents", "_p_new_ents", "_p_later"))
