"""Surrogates for personal data (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.common import fresh, stored

# Honorifics by gender, given names by script and gender, syllables of family names by script.
HONORIFICS = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"),
}
GIVEN = {
    "latin": {
        "f": ("Ada", "Bella", "Clara", "Diana", "Elena", "Flora", "Greta", "Hanna", "Irene", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"),
        "m": ("Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Max", "Noel", "Oskar", "Paul"),
    },
    "cyrillic": {
        "f": ("Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Мария"),
        "m": ("Антон", "Борис", "Виктор", "Глеб", "Иван", "Лев", "Олег", "Павел"),
    },
}
SYLLABLES = {
    "latin": ("ba", "den", "fel", "gor", "han", "jus", "kel", "lin", "mor", "nes", "per", "ran", "sol", "tim", "ver", "zan"),
    "cyrillic": ("ба", "вен", "гор", "дан", "жел", "кол", "лин", "мор", "нес", "пет", "ран", "сол", "тим", "фед", "хан", "чер"),
}

_TITLES = "|".join(sorted((t for names in HONORIFICS.values() for t in names), key=len, reverse=True))
#: Each pattern starts at the edge of a run and keeps what it took, so its time is linear in the text.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": r"(?<![\p{L}\p{N}])[0-9a-fA-F]{32,}+(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?![\p{N}]|\.\p{N})",
    "card": r"(?<!\p{N})(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\p{N})",
    "phone": r"(?<!\p{N})(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\p{N})|(?<!\p{N})\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\p{N})",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? \p{{Lu}}\p{{Ll}}++(?: \p{{Lu}}\p{{Ll}}++)?(?!\p{{L}})",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
_PLAIN = r"[^\p{L}\p{N}]"
_TITLE = rf"^(?:{_TITLES})\.? "


def may_hold(text: Column) -> Column:
    """A cheap test that every text with an entity passes: an at sign, a digit, a long run of hexadecimal letters, or an honorific."""
    named = text.rlike(r"[@\p{Nd}]|[a-fA-F]{32}")
    for title in (t for names in HONORIFICS.values() for t in names):
        named = named | text.contains(title + " ") | text.contains(title + ". ")
    return named


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern the whole mention has."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def canonical(kind: Column, mention: Column) -> Column:
    """What mentions of one entity share: letters and digits in lower case, for addresses with their marks, for names without the title."""
    whole = F.lower(mention)
    bare = F.regexp_replace(whole, _PLAIN, "")
    return F.when(kind.isin("email", "ip"), whole).when(kind == "name", F.regexp_replace(mention, _TITLE, "")).otherwise(bare)


def gender_of(mention: Column) -> Column:
    return F.when(mention.rlike(rf"^(?:{'|'.join(HONORIFICS['f'])})\b"), F.lit("f")).otherwise(F.lit("m"))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _number(seed: Column, i) -> Column:
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string") if isinstance(i, Column) else F.lit(str(i))), 256), 1, 12), 16, 10).cast("long")


def _letters(value: Column, seed: Column) -> Column:
    """Letters for letters and digits for digits of the value, drawn by the seed; other characters stay."""
    small, cyrillic, figures = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "0123456789"

    def one(i: Column) -> Column:
        c, n = F.substring(value, i, F.lit(1)), _number(seed, i)
        pick = lambda s: F.substring(F.lit(s), (n % len(s) + 1).cast("int"), F.lit(1))
        return (
            F.when(c.rlike(r"\d"), pick(figures)).when(c.rlike(r"\p{IsCyrillic}"), pick(cyrillic)).when(c.rlike(r"[\p{L}\p{N}]"), pick(small)).otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _hex(value: Column, seed: Column) -> Column:
    one = lambda i: F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 1)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _luhn(digits: Column) -> Column:
    """Check sum of a string of digits, modulo 10."""
    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    figures = _let(F.reverse(digits), lambda r: F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: F.substring(r, i, F.lit(1))))
    return F.aggregate(F.transform(figures, one), F.lit(0), lambda a, b: a + b) % 10


def _card(value: Column, seed: Column) -> Column:
    """Digits whose check sum is right exactly if the value's is."""
    def closed(drawn: Column) -> Column:
        right = (10 - _luhn(F.concat(drawn, F.lit("0")))) % 10
        last = F.when(_luhn(value) == 0, right).otherwise((right + 1 + _number(seed, 0) % 9) % 10)
        return F.concat(drawn, last.cast("string"))

    return _let(F.substring(_letters(value, seed), F.lit(1), F.length(value) - 1), closed)


def _phone(value: Column, seed: Column) -> Column:
    """The first digit stays, as part of the country code."""
    return F.concat(F.substring(value, 1, 1), F.substring(_letters(value, seed), F.lit(2), F.length(value)))


def _ip(value: Column, seed: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(seed, i) % 254 + 1).cast("string")), ".")


def _email(value: Column, seed: Column, attempt: Column) -> Column:
    """The part after the last dot stays. Each further attempt puts one more letter in front, so any number of addresses finds room."""
    end = F.regexp_extract(value, r"\.\p{L}+$", 0)
    letter = lambda i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (_number(seed, -i) % 26 + 1).cast("int"), F.lit(1))
    more = F.transform(F.sequence(F.lit(0), attempt), lambda i: F.when(i == 0, "").otherwise(letter(i)))
    return F.concat(F.array_join(more, ""), _letters(F.substring(value, F.lit(1), F.length(value) - F.length(end)), seed), end)


def _name(value: Column, gender: Column, seed: Column, attempt: Column) -> Column:
    """As many words as the value: a given name of the same gender and script before a made-up family name.

    The family name has three syllables and one more for each further attempt, so any number of names finds room.
    """
    def family(script: str) -> Column:
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        syllable = lambda i: F.get(parts, (_number(seed, i) % len(SYLLABLES[script])).cast("int"))
        # number 4 draws the given name
        more = F.transform(F.sequence(F.lit(0), attempt), lambda i: F.when(i == 0, "").otherwise(syllable(i + 4)))
        return F.initcap(F.concat(*[syllable(i) for i in (1, 2, 3)], F.array_join(more, "")))

    def given(script: str) -> Column:
        pick = lambda g: F.get(F.array(*map(F.lit, GIVEN[script][g])), (_number(seed, 4) % len(GIVEN[script][g])).cast("int"))
        return F.when(gender == "f", pick("f")).otherwise(pick("m"))

    def both(script: str) -> Column:
        return F.when(value.contains(" "), F.concat_ws(" ", given(script), family(script))).otherwise(family(script))

    return F.when(value.rlike(r"\p{IsCyrillic}"), both("cyrillic")).otherwise(both("latin"))


def surrogate(kind: Column, value: Column, gender: Column, secret: str, attempt: Column) -> Column:
    def drawn(seed: Column) -> Column:
        return (
            F.when(kind == "email", _email(value, seed, attempt)).when(kind == "secret", _hex(value, seed)).when(kind == "ip", _ip(value, seed))
            .when(kind == "card", _card(value, seed)).when(kind == "phone", _phone(value, seed)).otherwise(_name(value, gender, seed, attempt))
        )

    return _let(F.concat_ws("|", F.lit(secret), kind, value, attempt.cast("string")), drawn)


def entity_table(entities: DataFrame, secret: str, rounds: int = 100) -> DataFrame:
    """``kind, value, gender, surrogate`` for different ``entities (kind, value, gender)``, checked for collisions.

    Of entities that draw one surrogate the least keeps it; the others, and any whose surrogate is itself an entity of the data, draw again.
    Family names and addresses grow with each draw. Each round is a few grouped aggregates and joins; only a flag reaches the driver.
    """
    drawn = entities.withColumn("attempt", F.lit(0))
    for _ in range(rounds):
        table = stored(drawn.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("gender"), secret, F.col("attempt"))), "surrogates")
        first = table.groupBy("kind", "surrogate").agg(F.min(F.struct("value", "gender")).alias("holder"), F.count("*").alias("n"))
        shared = first.where("n > 1").select("kind", "surrogate", "holder")
        real = entities.select("kind", F.col("value").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        clash = table.join(shared, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left")
        again = F.col("real").isNotNull() | (F.col("holder").isNotNull() & (F.col("holder") != F.struct("value", "gender")))
        marked = clash.select("kind", "value", "gender", "attempt", again.alias("again"))
        if marked.where("again").isEmpty():
            return table.drop("attempt")
        drawn = marked.select("kind", "value", "gender", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    raise RuntimeError("surrogates still collide: too few are possible for their format")


def _worded(mention: Column, kind: Column, new: Column) -> Column:
    """The surrogate in the format of one mention: its marks, its capitals, its title. Letters in front of a longer address are capitals if the mention has nothing else."""
    more = F.when(kind == "email", F.greatest(F.length(new) - F.length(mention), F.lit(0))).otherwise(F.lit(0))
    front, base = F.substring(new, F.lit(1), more), F.substring(new, more + 1, F.length(new))
    front = F.when(mention == F.upper(mention), F.upper(front)).otherwise(front)

    def one(i: Column) -> Column:
        c = F.substring(mention, i, F.lit(1))
        at = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), _PLAIN, ""))
        drawn = F.substring(F.regexp_replace(base, _PLAIN, ""), at, F.lit(1))
        return F.when(c.rlike(_PLAIN), c).when(c.rlike(r"\p{Lu}"), F.upper(drawn)).otherwise(drawn)

    spelled = F.concat(front, F.array_join(F.transform(F.sequence(F.lit(1), F.length(mention)), one), ""))
    return F.when(kind == "ip", new).when(kind == "name", F.concat(F.regexp_extract(mention, _TITLE, 0), new)).otherwise(spelled)


def replace_pii(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each detected entity in ``text`` replaced, plus ``n_replaced`` (an own column of this name goes).

    Kinds: e-mail addresses, phone and card numbers, IPv4 addresses, hexadecimal secrets, names after an honorific. One entity has one surrogate
    in all documents and spellings; two entities never share one, and none is an entity of the data. Surrogates keep kind, length class, script,
    capitals, marks, top-level domain, gender and the state of a card's check sum. A null text stays null (0 replaced). Rows are told apart by
    key and text, so repeated rows change alike. An empty table gives an empty result.

    Documents without any entity never move. The others are shuffled once, to meet the list of their own mentions; a frequent entity combines map-side.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "n_replaced"])
    mark, found, new = fresh(docs, "mark", "found", "new")
    has = F.coalesce(may_hold(F.col(text)) & F.col(text).rlike(PATTERN), F.lit(False))
    touched = docs.where(has).withColumn(mark, F.xxhash64(text))
    mentions = touched.select(F.col(key).alias("of"), F.col(mark).alias("of_mark"), F.posexplode(F.regexp_extract_all(F.col(text), F.lit(PATTERN), 0)).alias("pos", "mention"))
    mentions = mentions.withColumn("kind", kind_of(F.col("mention")))
    mentions = mentions.withColumn("gender", F.when(F.col("kind") == "name", gender_of(F.col("mention"))).otherwise(F.lit("")))
    mentions = stored(mentions.withColumn("value", canonical(F.col("kind"), F.col("mention"))).distinct(), "mentions")
    entities = stored(mentions.select("kind", "value", "gender").distinct(), "entities")
    named = mentions.join(entity_table(entities, secret), ["kind", "value", "gender"])
    words = named.select("of", "of_mark", "pos", _worded(F.col("mention"), F.col("kind"), F.col("surrogate")).alias("new"))
    lists = words.groupBy("of", "of_mark").agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias(found))
    joined = touched.join(lists, touched[key].eqNullSafe(lists["of"]) & (touched[mark] == lists["of_mark"]))
    pieces = F.split(F.col(text), PATTERN, -1)
    words = F.concat(F.transform(F.col(found), lambda x: x["new"]), F.array(F.lit("")))
    changed = joined.withColumn(new, F.array_join(F.zip_with(pieces, words, lambda a, b: F.concat(a, b)), ""))
    columns = [F.col(new).alias(text) if c == text else F.col(c) for c in docs.columns]
    same = docs.where(~has).withColumn("n_replaced", F.lit(0))
    return same.unionByName(changed.select(*columns, F.size(found).alias("n_replaced")))
