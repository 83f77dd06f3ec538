"""Surrogates for personal data (DataFrame functions only).

One pattern finds entities; distinct values form a dictionary in which each gets a keyed surrogate of its type: mail
addresses stay mail addresses, addresses of the net have four octets, card numbers keep length, grouping and whether
their check digit holds, bank account numbers (IBAN) keep country and whether their check digits hold, phone numbers keep country code and grouping, secrets keep letter case and digits, streets keep what they end on, dates of birth are
shifted by a keyed number of days, names after a title, a statement ("my name is") or a field ("Name:") keep the title, gender and script.  A secret is the whole value behind its keyword, of any length: to the closing
quote where it is quoted, else to a quote or white space, without closing punctuation.  Names are replaced by their parts, so a family name has one surrogate with
or without a given name; the parts of the names found in a document are also replaced where they stand in it
without a title (also in capitals, in hyphenated words, before 's), but for names that are also words at the start of
a sentence and before a small letter.  Surrogates are checked: one that another value has, or that stands as an original, is drawn
again with the next attempt number, so distinct values stay distinct and equal ones equal in the whole table.

Defined results: null text stays null; texts without entities are unchanged; empty tables give no rows; repeated rows
give equal rows; all columns are kept, but those named n_entities and kinds give way to the result's when counts are
asked for; after ATTEMPTS draws a number is appended to the surrogate, which gives up the
format rather than distinctness.
"""

from __future__ import annotations

import re
import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, hot_join, rejoin, row_key, saved, shuffled

ATTEMPTS = 12
#: Names the secret key of the surrogates; whoever has it can test guesses of originals.
KEY_SETTING = "spark.quire.surrogate.key"
# Titles by gender; those that end in a dot are titles only with it.
MALE = ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sir", "Signor", "M.", "Sr.", "господин", "г-н"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Signora", "Mme", "Mlle", "Sra", "Srta", "Dra", "госпожа", "г-жа"]
#: Statements and fields that a name follows; they count as titles without gender.
STATED = ["My name is", "my name is", "My Name is", "Mein Name ist", "mein Name ist", "Ich heiße", "ich heiße", "Je m'appelle", "je m'appelle", "Je m’appelle", "je m’appelle", "Mon nom est", "mon nom est", "Me llamo", "me llamo", "Mi nombre es", "mi nombre es", "Меня зовут", "меня зовут", "Name:", "Full name:", "Full Name:", "Nom:", "Nombre:", "Patient:", "Customer:"]
NEUTRAL = ["Dr", "Doctor", "Prof", "Professor", "Rev", "Mx", "доктор", "профессор"]
# Surrogate given names and syllables by script.
GIVEN = {
    "m_latin": "Adrian Bruno Carl Damian Edgar Felix Gregor Hugo Ivan Jonas Kasper Leon Martin Nico Oskar Pablo Ruben Simon Tobias Victor",
    "f_latin": "Alma Bianca Clara Diana Elena Flora Greta Helena Ines Julia Katja Lena Marta Nora Olga Paula Rosa Sofia Tilda Vera",
    "n_latin": "Alexis Ariel Avery Casey Dana Eden Jamie Jordan Kim Lee Morgan Noel Quinn Robin Sascha Taylor",
    "m_cyrillic": "Андрей Борис Виктор Глеб Денис Егор Игорь Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур",
    "f_cyrillic": "Алла Вера Галина Дарья Елена Жанна Зоя Инна Кира Лариса Марина Нина Ольга Полина Раиса Софья",
    "n_cyrillic": "Валя Женя Паша Саша Слава Тоня Шура",
}
SYLLABLES = {
    "latin": "ba ben cor dal den fer gan hal jor kel lan mar mon nor pel ran ros sel tal tor val ven wil zan",
    "cyrillic": "бел вор гор дан жар зим кор лаз мар нор пол рат сел тор чер яр",
}
TITLE = "(?:" + "|".join(re.escape(x) if x[-1] in ".:" else rf"{x}\.?" for x in sorted(MALE + FEMALE + NEUTRAL + STATED, key=lambda x: (-len(x), x))) + ")"
NAME_WORD = r"\p{Lu}(?=[\p{L}'’-])\p{L}*(?:(?!['’]s(?!\p{L}))['’-]\p{L}+)*"
#: Family and given names that are also words: at the start of a sentence and before a small letter they are left as words.
WORDS = """April Baker Banks Berg Bishop Black Blanc Blanco Braun Brown Bush Butler Carpenter Cook Cruz Dawn Day Faith Field Fields Fisher
Flores Fox Gold Grace Grand Green Groß Hall Hill Hope Hunter Joy Jung June Klein Koch King König Kurz Lake Lang Long Major Mark Marsh Mason
May Miller Moreno Noir Page Park Parks Penny Petit Pope Potter Price Reich Reyes Rich River Rivers Rojo Rose Roth Roux Rubio Schwarz Shepherd
Short Silver Smith Snow Stein Stone Summer Summers Taylor Turner Walker Weaver Weiß White Will Winter Winters Wolf Wood Woods Young""".split()
# What may be a detected name without its title.
BARE = rf"(?<!\p{{L}})(?!(?<=^|[.!?]\s|[.!?][\"”’]\s|\n)(?:{'|'.join(WORDS)})\s\p{{Ll}}){NAME_WORD}(?!\p{{L}})"
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
# Before a secret: a keyword, also as part of a longer key (secret_access_key, apiKeyValue), and = or :.
KEYED = r"(?i:password|passwd|secret|token|api[_-]?key)(?:[_-]\w[\w-]{0,40}|(?<=[a-z])[A-Z]\w{0,40}|(?i:key))?[\"']?(?:\s?[=:]\s?|\s(?:is|ist|est|es)\s)[\"']?"
# After "is" only what holds a digit is a secret: other words may be prose.
IS = r"(?<=\s(?:is|ist|est|es)\s[\"']?)"
DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})"
# What ends the name of a street.
STREET = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Terrace|Crescent|Highway|Parkway"
# Secrets come first, so that no shorter entity takes a part of one.
PARTS = {
    "secret": rf"(?<=[=:\"']|[=:st]\s)(?<={KEYED})(?:(?!{IS})|(?=[^\s\"']*\d))(?:"
    r"(?<=\")(?=[^\"\r\n]*[\p{L}\p{N}])[^\"\r\n]{8,}(?=\")|(?<=')(?=[^'\r\n]*[\p{L}\p{N}])[^'\r\n]{8,}(?=')|(?=[^\s\"']*[\p{L}\p{N}])[^\s\"']{7,}[^\s\"',;.)\]}>])",
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)",
    "ip6": r"(?<![\w:.])(?=[0-9A-Fa-f:]{0,45}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])",
    "birth": rf"(?<=(?i:born|born on|of birth|dob|geboren am|geboren|né le|née le|nacido el|nacida el):? ){DATE}(?!\w)",
    "street": rf"(?<![\w-])\d{{1,5}}[A-Za-z]? (?:\p{{Lu}}[\p{{L}}'’-]{{1,30}} ){{1,3}}(?:{STREET})(?![\w-])",
    "access": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "card": r"(?<![\w-])(?:\d{4}(?:[ -]\d{4}){3}|\d{13,19})(?![\w-]{0,40}\d|[A-Za-z_])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|0\d{2,4}[ /-]\d{3,4}[ -]?\d{3,5}|\(\d{3}\) ?\d{3}[ -]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?![\w-]{0,40}\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": rf"(?<!\p{{L}})(?:{TITLE} )++{NAME_WORD}(?: {NAME_WORD})?",
}
# All but secrets begin with one of these signs and not within a Latin word: most places are passed over at once.
INITIALS = "A-Za-z0-9+(" + "".join(sorted({x[0] for x in MALE + FEMALE + NEUTRAL + STATED if not x[0].isascii()}))
ENTITY = PARTS["secret"] + rf"|(?<![A-Za-z])(?=[{INITIALS}])(?:" + "|".join(v for k, v in PARTS.items() if k != "secret") + ")"


def entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def kind(value: Column) -> Column:
    whole = lambda name: value.rlike(f"^(?:{PARTS[name]})$")
    out = F.when(whole("mail"), "mail")
    for name in ("ip", "ip6", "access", "iban", "card", "ssn", "phone", "street"):
        out = out.when(whole(name), name)
    out = out.when(value.rlike(f"^{DATE}$"), "birth")
    return out.when(whole("name"), "name").otherwise("secret")


def _hash(key: str, kind_: Column, attempt: Column, value: Column) -> Column:
    """128 hexadecimal digits that depend on the key."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind_, attempt.cast("string"), value), 512)


def _byte(h: Column, i: Column) -> Column:
    return F.conv(F.substring(h, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _masked(value: Column, h: Column, is_hex: Column) -> Column:
    """Digits to digits, letters to letters of the same case and script (small Latin ones for scripts other than Latin and Cyrillic), signs as they are; hexadecimal stays so."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(h, i)
        draw = lambda start, n: F.chr(F.lit(start) + b % n)
        return (F.when(c.rlike("[0-9]"), draw(48, 10)).when(is_hex & c.rlike("[a-f]"), draw(97, 6)).when(is_hex & c.rlike("[A-F]"), draw(65, 6)).when(c.rlike("[a-z]"), draw(97, 26)).when(c.rlike("[A-Z]"), draw(65, 26))
                .when(c.rlike(r"\p{IsLatin}") & c.rlike(r"\p{Lu}"), draw(65, 26)).when(c.rlike(r"\p{IsLatin}"), draw(97, 26))
                .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), F.substring(F.lit(CYRILLIC.upper()), b % 32 + 1, F.lit(1))).when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit(CYRILLIC), b % 32 + 1, F.lit(1)))
                .when(c.rlike(r"[\p{L}\p{N}\p{M}]"), draw(97, 26)).otherwise(c))

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 1, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")).otherwise(d.cast("int"))),
        F.lit(0), lambda a, x: a + x) % 10


def _card(value: Column, h: Column) -> Column:
    body = F.concat(F.substring(value, F.lit(1), F.lit(1)), F.expr("substring(masked, 2, length(masked) - 2)"))
    digits = lambda x: F.regexp_replace(x, "[^0-9]", "")
    check = (10 - _luhn(F.concat(digits(body), F.lit("0")))) % 10
    last = F.when(_luhn(digits(value)) == 0, check).otherwise((check + 1 + _byte(h, F.lit(63)) % 9) % 10)
    return F.concat(body, last.cast("string"))


def _mod97(value: Column) -> Column:
    """Remainder by 97 of digits and capitals, a capital read as 10 to 35."""
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(value, ""), F.lit(0), step)


def _iban(value: Column, h: Column) -> Column:
    """Country, check digits that hold if and only if the original's do, and the masked rest."""
    country, rest = F.substring(value, F.lit(1), F.lit(2)), F.expr("substring(masked, 5)")
    plain = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    check = 98 - _mod97(F.concat(plain(rest), country, F.lit("00")))
    holds = _mod97(F.concat(plain(F.expr("substring(value, 5)")), F.substring(value, F.lit(1), F.lit(4)))) == 1
    digits = F.when(holds, check).otherwise((check - 1 + _byte(h, F.lit(62)) % 96) % 97 + 2)
    return F.concat(country, F.lpad(digits.cast("string"), 2, "0"), rest)


def _syllables(script: str, h: Column, count: Column) -> Column:
    words = SYLLABLES[script].split()
    table = F.array(*[F.lit(w) for w in words])
    return F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(table, _byte(h, i + 3) % len(words) + 1)), ""))


def _name_part(kind_: Column, value: Column, attempt: Column, h: Column) -> Column:
    """Given names from the list of their gender and script, beyond that and for family names from syllables."""
    out = None
    for script in SYLLABLES:
        for gender in "mfn":
            names = GIVEN[f"{gender}_{script}"].split()
            pick = F.element_at(F.array(*[F.lit(x) for x in names]), _byte(h, F.lit(0)) % len(names) + 1)
            ending = {"m_latin": "o", "f_latin": "a", "n_latin": "e", "m_cyrillic": "ий", "f_cyrillic": "а", "n_cyrillic": "о"}[f"{gender}_{script}"]
            made = F.when(attempt == 0, pick).otherwise(F.concat(_syllables(script, h, F.lit(2) + F.least(attempt / 3, F.lit(3)).cast("int")), F.lit(ending)))
            cond = kind_ == f"given_{gender}_{script}"
            out = F.when(cond, made) if out is None else out.when(cond, made)
        family = _syllables(script, h, F.lit(3) + F.least(attempt / 3, F.lit(3)).cast("int"))
        if script == "cyrillic":
            family = F.concat(family, F.when(value.rlike("(а|ая)$"), "ова").otherwise("ов"))
        out = out.when(kind_ == f"family_{script}", family)
    return out


def surrogate(key: str, kind_: Column, value: Column, attempt: Column) -> Column:
    """Keyed replacement; expects columns `value` and `masked` = _masked(value, hash) beside it."""
    h, masked = _hash(key, kind_, attempt, value), F.col("masked")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(h, i) % 254 + 1).cast("string")), ".")
    domain = F.substring_index(value, "@", -1)
    below = F.regexp_replace(domain, r"[^.]+\.[^.]+$", "")
    mail = F.concat(F.substring_index(masked, "@", 1), F.when(attempt > 3, F.concat(F.lit("."), F.substring(h, F.lit(1), attempt))).otherwise(""), F.lit("@"), below, F.lit("example."), F.substring_index(domain, ".", -1))
    code = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])|^0|^", 0)
    phone = F.concat(code, F.substring(masked, F.length(code) + 1, F.length(value)))
    # the number of the house keeps its first digit from being 0; the kind of street stays
    end = F.substring_index(value, " ", -1)
    street = F.concat((_byte(h, F.lit(61)) % 9 + 1).cast("string"), F.substring(masked, F.lit(2), F.length(value) - F.length(end) - 1), end)
    access = F.concat(F.substring(value, F.lit(1), F.lit(4)), F.expr("substring(masked, 5)"))
    return (F.when(kind_ == "mail", mail).when(kind_ == "ip", octets).when(kind_ == "card", _card(value, h)).when(kind_ == "phone", phone).when(kind_ == "access", access)
            .when(kind_ == "iban", _iban(value, h)).when(kind_ == "street", street).when(kind_.rlike("^(given|family)_"), _name_part(kind_, value, attempt, h)).otherwise(masked))


def assign(tokens: DataFrame, key: str) -> DataFrame:
    """(kind, value) distinct rows to (kind, value, surrogate), surrogates distinct within a kind and never an original."""
    originals = saved(tokens.select("kind", "value"), "originals")
    pending, done = originals, None
    for attempt in range(ATTEMPTS + 1):
        # Columns of their own: inside the mask they would be worked out again for each character.
        tried = pending.withColumns({"h": _hash(key, F.col("kind"), F.lit(attempt), F.col("value")), "is_hex": F.col("value").rlike("^[0-9a-f]{8,}$") | (F.col("kind") == "ip6")})
        tried = tried.withColumn("masked", _masked(F.col("value"), F.col("h"), F.col("is_hex")))
        drawn = surrogate(key, F.col("kind"), F.col("value"), F.lit(attempt))
        if attempt == ATTEMPTS:
            drawn = F.concat(drawn, F.lit("-"), F.substring(_hash(key, F.col("kind"), F.lit(attempt), F.col("value")), 1, 32))
        tried = saved(tried.select("kind", "value", drawn.alias("surrogate")), "tried")
        first = tried.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        good = first.join(shuffled(originals.select("kind", F.col("value").alias("surrogate"))), ["kind", "surrogate"], "left_anti")
        if done is not None:
            good = good.join(shuffled(done.select("kind", "surrogate")), ["kind", "surrogate"], "left_anti")
        good = saved(good.select("kind", "value", "surrogate"), "accepted")
        pending = saved(tried.select("kind", "value").join(shuffled(good.select("kind", "value")), ["kind", "value"], "left_anti"), "pending")
        done = good if done is None else done.unionByName(good)
        if pending.isEmpty():
            break
    return done


def _shifted(value: Column, key: str) -> Column:
    """A date of birth as many days off as the key says, in the same form; what is no date loses its digits."""
    h = _hash(key, F.lit("birth"), F.lit(0), F.lit(""))
    days = (_byte(h, F.lit(0)) * 256 + _byte(h, F.lit(1))) % 3000 + 300
    forms = ["yyyy-MM-dd", *[f"{d}{sign}{m}{sign}yyyy" for sign in "./" for d in ("d", "dd") for m in ("M", "MM")]]
    fits = lambda form: value.rlike("^" + re.sub("[dMy]+", lambda x: rf"\d{{{len(x[0])}}}", form.replace(".", "[.]")) + "$")
    moved = [F.when(fits(form), F.date_format(F.date_sub(F.try_to_timestamp(value, F.lit(form)).cast("date"), days), form)) for form in forms]
    return F.coalesce(*moved, F.regexp_replace(value, "[0-9]", "0"))


def dictionary(found: DataFrame, key: str) -> DataFrame:
    """value, surrogate, n, kind, bare (part in small letters, rank, surrogate of the parts of a name) for a table of (value, n)."""
    # Read several times below, so written once: else each plan would hold the counting and the patterns of all kinds again.
    typed = saved(found.withColumn("kind", kind(F.col("value"))), "typed")
    plain, names = typed.where("kind <> 'name'"), typed.where("kind = 'name'")
    title = F.regexp_extract("value", f"^((?:{TITLE} )++)", 1)
    parts = F.split(F.expr("substring(value, length(title) + 1)"), " ")
    script = F.when(F.col("value").rlike(r" \p{IsCyrillic}"), "cyrillic").otherwise("latin")
    has = lambda titles: F.arrays_overlap(F.split(F.regexp_replace("title", r"\.", ""), " "), F.array(*[F.lit(x.rstrip(".")) for x in titles]))
    names = names.withColumn("title", title).withColumn("parts", parts)
    names = names.select("value", "n", F.rtrim("title").alias("title"), F.when(F.size("parts") == 2, F.col("parts")[0]).alias("given"), F.element_at("parts", -1).alias("family"), script.alias("script"), F.when(has(MALE), "m").when(has(FEMALE), "f").alias("gender"))
    # A given name after a title of no gender has the gender that other titles give it.
    known = names.where("gender IS NOT NULL AND given IS NOT NULL").groupBy("given", "script").agg(F.min("gender").alias("known"))
    names = names.join(shuffled(known), ["given", "script"], "left").withColumn("gender", F.coalesce("gender", "known", F.lit("n")))
    names = names.select("value", "n", "title", "given", "family", F.concat_ws("_", F.lit("given"), "gender", "script").alias("given_kind"), F.concat_ws("_", F.lit("family"), "script").alias("family_kind"))
    names = saved(names, "names")
    tokens = (plain.select("kind", "value").unionByName(names.where("given IS NOT NULL").select(F.col("given_kind").alias("kind"), F.col("given").alias("value")))
              .unionByName(names.select(F.col("family_kind").alias("kind"), F.col("family").alias("value")))).distinct()
    dates = tokens.where("kind = 'birth'").select("kind", "value", _shifted(F.col("value"), key).alias("surrogate"))
    drawn = assign(tokens.where("kind <> 'birth'"), key).unionByName(dates)
    entry = lambda part, rank: F.struct(F.lower(part).alias("k"), F.lit(rank).alias("r"), F.col(f"new_{part}").alias("s"))
    bare = F.filter(F.array(entry("family", 0), entry("given", 1)), lambda x: x["k"].isNotNull())
    plain = plain.join(shuffled(drawn), ["kind", "value"]).select("value", "surrogate", "n", "kind", F.lit(None).cast("array<struct<k:string,r:int,s:string>>").alias("bare"))
    side = lambda a: drawn.select(F.col("kind").alias(f"{a}_kind"), F.col("value").alias(a), F.col("surrogate").alias(f"new_{a}"))
    named = names.join(shuffled(side("family")), ["family_kind", "family"]).join(shuffled(side("given")), ["given_kind", "given"], "left")
    return plain.unionByName(named.select("value", F.concat_ws(" ", "title", "new_given", "new_family").alias("surrogate"), "n", F.lit("name").alias("kind"), bare.alias("bare")))


def _called(names: Column, word: Column) -> Column:
    """Surrogate of a word that is a detected name or a hyphenated word with one; null for others."""

    def one(w: Column) -> Column:
        new = F.try_element_at(names, F.lower(w))
        return F.when(w == F.upper(w), F.upper(new)).otherwise(new)

    pieces = F.split(word, "-")
    inside = F.when(F.exists(pieces, lambda w: one(w).isNotNull()), F.array_join(F.transform(pieces, lambda w: F.coalesce(one(w), w)), "-"))
    return F.coalesce(one(word), inside)


def _bare_woven(names: Column, gap: Column) -> Column:
    """Text between entities, with the document's own detected names replaced where they stand without a title."""
    words = F.transform(F.regexp_extract_all(gap, F.lit(BARE), F.lit(0)), lambda w: F.coalesce(_called(names, w), w))
    return F.array_join(F.zip_with(F.split(gap, BARE, -1), F.array_append(words, F.lit("")), lambda g, w: F.concat(g, w)), "")


def surrogate_key(spark: SparkSession) -> str:
    """The session's setting KEY_SETTING; without it a fresh random key, so that no mapping can be found out later."""
    return spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)


def replace_pii(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text", counts: bool = True) -> DataFrame:
    """`secret` is the key of the surrogates.  The input with entities in `text` replaced; with counts also n_entities and kinds (distinct, sorted, comma-joined)."""
    more = ["n_entities", "kinds"] if counts else []
    docs = docs.drop(*more)
    keyed = docs.withColumn(ROW, row_key(key, text))
    found = entities(F.col(text))
    hits = saved(keyed.select(ROW, found.alias("m")).where("size(m) > 0").distinct(), "hits")
    spots = hits.select(ROW, F.posexplode("m").alias("at", "value"))
    table = saved(dictionary(spots.groupBy("value").agg(F.count(F.lit(1)).alias("n")), secret), "dictionary")
    placed = hot_join(spots, table, "value", "n", spots.count())
    side = placed.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("s"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("__quire_kinds"), F.array_sort(F.flatten(F.collect_set("bare"))).alias("b"))
    # Of a part that is a given and a family name, the family name's surrogate.
    first = F.filter("b", lambda x, i: (i == 0) | (F.get(F.col("b"), i - 1)["k"] != x["k"]))
    called = F.when(F.size("b") > 0, F.map_from_entries(F.transform(first, lambda x: F.struct(x["k"], x["s"]))))
    side = saved(side.select(ROW, F.transform("s", lambda x: x["surrogate"]).alias("__quire_new"), "__quire_kinds", called.alias("__quire_names")), "placed")
    out = rejoin(keyed, side, "left")
    gaps, new, names = F.split(F.col(text), ENTITY, -1), F.col("__quire_new"), F.col("__quire_names")
    more_named = F.aggregate(gaps, F.lit(0), lambda n, g: n + F.size(F.filter(F.regexp_extract_all(g, F.lit(BARE), F.lit(0)), lambda w: _called(names, w).isNotNull())))
    out = out.withColumn("__quire_more", F.when(names.isNull(), F.lit(0)).otherwise(more_named)) if counts else out
    gaps = F.when(names.isNull(), gaps).otherwise(F.transform(gaps, lambda g: _bare_woven(names, g)))
    woven = F.array_join(F.zip_with(gaps, F.array_append(new, F.lit("")), lambda g, n: F.concat(g, n)), "")
    out = out.withColumn(text, F.when(new.isNull(), F.col(text)).otherwise(woven))
    if counts:
        out = out.withColumns({"n_entities": F.when(new.isNull(), F.lit(0)).otherwise(F.size(new) + F.col("__quire_more")).cast("long"), "kinds": F.coalesce("__quire_kinds", F.lit(""))})
    return out.select(*docs.columns, *more)
