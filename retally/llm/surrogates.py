"""Personal data replaced by keyed surrogates.

Entities are found by form: mail and network addresses, telephone numbers, payment cards (with a valid
check digit), social security numbers, account numbers and persons behind a title.  Each has a canonical value
(digits only, lower case, ...), which is replaced by a surrogate of the same type: digits by digits, letters by letters,
as many of them, with country code, card scheme and check digit kept right; names by names of the same script and of
the gender the title tells.  A surrogate is derived from a keyed digest, so an entity has the same one in every
document and in every spelling of its format.

Collisions are checked: a surrogate that equals a value found in the corpus, or the surrogate of another entity, is
drawn again with the next attempt number until all are distinct.  Each round is a written table and
handles only what lost in the round before, which is a small part of it.

DataFrame functions throughout.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from retally.llm.common import kept, workspace

#: Titles by gender.
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Г-жа|Κυρία"
MALE = "Mr|Sir|Herr|Monsieur|Señor|Sr|Г-н|Κύριος"
NEUTRAL = "Dr|Prof"
FEMALE, MALE, NEUTRAL = f"{FEMALE}|{FEMALE.upper()}|ΚΥΡΙΑ", f"{MALE}|{MALE.upper()}|ΚΥΡΙΟΣ", f"{NEUTRAL}|{NEUTRAL.upper()}"
TITLE = f"{FEMALE}|{MALE}|{NEUTRAL}"
#: A part of a name: initials, or a word with inner capitals, hyphens and apostrophes (that of a genitive is not its own).
PART = (r"(?:\p{Lu}(?:\.(?:-?\p{Lu}\.)*+|(?=\x20\p{Lu}))"
        r"|\p{Lu}(?:[\p{L}\p{M}]++|(?=['’]\p{Lu}\p{L}))(?:['’]\p{Lu}[\p{L}\p{M}]++|-\p{L}[\p{L}\p{M}]++)*+)")

#: Entity forms in the order they are tried at one place.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}(?![A-Za-z0-9])",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-])",
    "phone": r"(?<![\p{L}\d+(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?![\p{L}\d-])"
             r"|(?<![\p{L}\d])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\p{L}\d])",
    # MS without a dot is a company
    "person": rf"(?<!\p{{L}})(?!MS\x20)(?:{TITLE})\.?\x20{PART}(?:\x20{PART})*(?!\p{{L}})",
}
ANY = "|".join(f"(?:{form})" for form in FORMS.values())
KINDS = (*FORMS, "given", "family")

#: Syllables names are made of, by script; the ending tells the gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga ha jo ka ke la le li lo lu ma me mi mo na ne ni no ra re ri ro sa se si ta te ti to va vi",
    "cyrillic": "ба бе бо ва ви га да де за ка ке ко ла ле ли ло ма ми мо на не ни но ра ре ри ро са се си та те ти то",
    "greek": "βα βε γα γε δα δε θα κα κε κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι τα τε τι",
}
ENDINGS = {("latin", "f"): "lia", ("latin", "m"): "rdo", ("latin", "n"): "ren", ("cyrillic", "f"): "ина", ("cyrillic", "m"): "ор",
           ("cyrillic", "n"): "ен", ("greek", "f"): "ίνα", ("greek", "m"): "ιος", ("greek", "n"): "εν"}
MOST_ROUNDS = 64


def _chars(text: Column) -> Column:
    return F.split(text, "", -1)


def _number(code: Column, i: Column, below: int) -> Column:
    """A number under ``below`` from the i-th byte pair of a hex digest (used round and round)."""
    return F.conv(F.substring(code, (i % 14) * 4 + 1 + F.floor(i / 14).cast("int") % 4, F.lit(4)), 16, 10).cast("long") % below


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Sum modulo 10 of a digit string with every second digit from the right doubled."""
    one = F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(
        F.floor(c.try_cast("int") * 2 / 10) + c.try_cast("int") * 2 % 10).cast("int"))
    return F.aggregate(one, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def mod97(account: Column) -> Column:
    """The check value of an account number (1 where it is right): its first four characters last, letters as two digits."""
    turned = F.concat(F.substring(account, 5, 100), F.substring(account, 1, 4))
    value = lambda c: F.conv(c, 36, 10).cast("int")
    return F.aggregate(F.filter(_chars(turned), lambda c: c != ""), F.lit(0), lambda a, c: F.when(
        value(c) > 9, (a * 100 + value(c)) % 97).otherwise((a * 10 + value(c)) % 97))


def keyed(key: str, *parts: Column) -> Column:
    """HMAC-SHA256 of the parts in hex; each part is told by its length, so that no two lists of parts are one message."""
    block = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    pad = lambda b: F.lit(bytes(c ^ b for c in block.ljust(64, b"\0")))
    message = F.concat(*[F.concat(F.char_length(part).cast("string"), F.lit(":"), part) for part in parts])
    inner = F.unhex(F.sha2(F.concat(pad(0x36), F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(pad(0x5C), inner), 256)


def kind_of(match: Column) -> Column:
    """The form a match has; null for a row of digits that is no card, and for a code that is no account number."""
    found = F.lit(None).cast("string")
    for kind, form in reversed(FORMS.items()):
        is_it = F.regexp_like(match, F.lit(f"^(?:{form})$"))
        found = F.when(is_it, F.lit(kind)).otherwise(found)
    return F.when((found == "card") & (luhn(_digits(match)) != 0), None).when(
        (found == "iban") & (mod97(F.regexp_replace(match, " ", "")) != 1), None).otherwise(found)


def _script(name: Column) -> Column:
    return F.when(F.regexp_like(name, F.lit(r"^\p{IsCyrillic}")), "cyrillic").when(
        F.regexp_like(name, F.lit(r"^\p{IsGreek}")), "greek").otherwise("latin")


def entities_in(docs: DataFrame) -> DataFrame:
    """``(rid, i, match, kind)``: the entities of ``docs(rid, text)``; ``i`` counts the matches of a row."""
    found = docs.select("rid", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("i", "match"))
    return found.distinct().withColumn("kind", kind_of(F.col("match"))).where("kind is not null")


def mentions(found: DataFrame) -> DataFrame:
    """One row per entity, or per part of a person's name: ``(rid, i, j, match, kind, value, trait)``.

    ``value`` is canonical; ``trait`` is what a surrogate must keep.
    """
    m, kind = F.col("match"), F.col("kind")
    country = F.regexp_extract(m, r"^\+(\d{1,3}?)(?=[ .(-]|\d{6,})", 1)
    plain = found.where("kind <> 'person'").select(
        "rid", "i", F.lit(0).alias("j"), "match", "kind",
        F.when(kind == "email", F.lower(m)).when(kind == "ip", m).when(kind == "iban", F.regexp_replace(m, " ", "")).when(
            kind == "phone", F.concat(F.when(m.startswith("+"), "+").otherwise(""), _digits(m))).otherwise(
            _digits(m)).alias("value"),
        F.when(kind == "phone", country).when(kind == "card", F.substring(m, 1, 1)).when(
            kind == "iban", F.substring(m, 1, 2)).otherwise("").alias("trait"))
    title, names = F.regexp_extract(m, rf"^({TITLE})", 1), F.split(F.regexp_replace(m, rf"^(?:{TITLE})\.?\x20", ""), " ")
    gender = F.when(F.regexp_like(title, F.lit(f"^(?:{FEMALE})$")), "f").when(
        F.regexp_like(title, F.lit(f"^(?:{MALE})$")), "m").otherwise("n")
    people = found.where("kind = 'person'").select("rid", "i", "match", gender.alias("gender"), F.posexplode(names).alias("j", "name"),
                                                   F.size(names).alias("parts"))
    given = F.col("j") < F.col("parts") - 1
    people = people.select("rid", "i", "j", "match", F.when(given, "given").otherwise("family").alias("kind"),
                           F.translate(F.lower("name"), "’", "'").alias("value"), F.concat_ws(":", _script(F.col("name")), F.when(
                               given, F.col("gender")).otherwise("n")).alias("trait"))
    return plain.unionByName(people)


def candidate(kind: Column, value: Column, trait: Column, key: str, attempt: int) -> Column:
    """The surrogate an attempt proposes for a canonical value."""
    code = keyed(key, kind, value, trait, F.lit(str(attempt)))
    pick = lambda i, letters: F.substring(F.lit(letters), (_number(code, i, len(letters)) + 1).cast("int"), F.lit(1))
    # with many attempts a value gets longer, as its own forms are used up: mail by the attempt, names by a syllable for
    # every two, telephone and social security numbers by a digit for every four, after a draw over all first digits
    longer = F.lit("" if attempt < 8 else str(attempt))
    wide, more = attempt >= 4, max(0, attempt - 4) // 4
    same_shape = lambda text: F.array_join(F.transform(_chars(text), lambda c, i: F.when(
        F.regexp_like(c, F.lit("[0-9]")), pick(i, "0123456789")).when(F.regexp_like(c, F.lit("[A-Z]")), pick(
            i, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(F.regexp_like(c, F.lit("[a-z]")), pick(
                i, "abcdefghijklmnopqrstuvwxyz")).otherwise(c)), "")
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    house = F.concat(F.lit("mail-"), F.substring(keyed(key, F.lit("host"), host), 1, 8),
                     F.lit(".example"))
    octet = lambda i, low, high: (_number(code, F.lit(i), high - low) + low).cast("string")
    digits = _digits(value)
    rest = F.length(digits) - F.length(trait)
    drawn = lambda n: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(
        (i == 0) & F.lit(not wide), (_number(code, i, 8) + 2).cast("string")).otherwise(pick(i, "0123456789"))), "")
    unchecked = F.concat(trait, drawn(F.length(digits) - 2))
    check = ((10 - luhn(F.concat(unchecked, F.lit("0")))) % 10).cast("string")
    account = same_shape(F.substring(value, 5, 100))
    name = F.lit(None).cast("string")
    for (script, gender), ending in ENDINGS.items():
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script].split()])
        count = len(SYLLABLES[script].split())
        stem = F.concat(*[F.element_at(syllables, (_number(code, F.lit(i), count) + 1).cast("int"))
                          for i in range(3 + attempt // 2)])
        end = F.when(kind == "given", F.lit(ending)).otherwise(F.lit(ENDINGS[script, "n"]))
        name = F.when(trait == f"{script}:{gender}", F.concat(stem, end)).otherwise(name)
    return (F.when(kind == "email", F.concat(same_shape(local), longer, F.lit("@"), house))
            .when(kind == "ip", F.concat_ws(".", octet(0, 11, 224), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 255)))
            .when(kind == "phone", F.concat(F.when(value.startswith("+"), "+").otherwise(""), trait, drawn(rest + more)))
            .when(kind == "card", F.concat(unchecked, check))
            .when(kind == "ssn", F.concat(F.lit("9"), drawn(F.lit(8 + more))))
            .when(kind == "iban", F.concat(trait, F.lpad((98 - mod97(F.concat(trait, F.lit("00"), account))).cast("string"), 2, "0"), account))
            .otherwise(name))


def surrogates(entities: DataFrame, key: str, home: str) -> DataFrame:
    """``(kind, value, trait, surrogate)`` for distinct ``entities(kind, value, trait)``; all surrogates of a kind differ."""
    entities = kept(entities, f"{home}/entities")
    originals = entities.select("kind", F.col("value").alias("surrogate"))
    todo, done = entities, None
    for attempt in range(MOST_ROUNDS):
        drawn = todo.withColumn("surrogate", candidate(F.col("kind"), F.col("value"), F.col("trait"), key, attempt))
        free = drawn.join(originals, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min(F.struct("value", "trait")).alias("won"))
        won = kept(first.select("kind", "won.value", "won.trait", "surrogate"), f"{home}/won-{attempt}")
        done = won if done is None else done.unionAll(won)
        todo = kept(todo.join(won, ["kind", "value", "trait"], "left_anti"), f"{home}/todo-{attempt}")
        if todo.isEmpty():
            return done
    raise RuntimeError("a kind of entity has more values than surrogates")


def _rendered(match: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the format of the match: its spaces, brackets and case; what a longer one has more comes last."""
    bare = F.regexp_replace(surrogate, "[^A-Za-z0-9]", "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    filled = F.aggregate(_chars(match), start, lambda a, c: F.when(F.regexp_like(c, F.lit("[A-Za-z0-9]")), F.struct(
        F.concat(a["out"], F.substring(bare, a["n"] + 1, F.lit(1))).alias("out"), (a["n"] + 1).alias("n"))).otherwise(
        F.struct(F.concat(a["out"], c).alias("out"), a["n"].alias("n"))), lambda a: F.concat(
            a["out"], F.substring(bare, a["n"] + 1, F.length(bare))))
    upper = F.regexp_like(match, F.lit("^[^a-z]*$")) & F.regexp_like(match, F.lit("[A-Z]"))
    mail = F.when(upper, F.upper(surrogate)).otherwise(surrogate)
    return F.when(kind == "email", mail).when(kind == "ip", surrogate).otherwise(filled)


def _count(kinds: Column, kind: str) -> Column:
    return F.size(F.filter(kinds, lambda x: x == kind)).cast("long")


def settled(seen: DataFrame) -> DataFrame:
    """``(kind, value, trait, who)`` for distinct ``seen(kind, value, trait)``: the trait that tells an entity's surrogate.

    A name under titles of both genders is two people's, with a surrogate for each gender.  Where a title tells none, a name that
    has one gender elsewhere keeps it.  What is not a name is one entity however its trait was read.
    """
    open_ = F.col("trait").endswith(":n")
    gender = F.when(~open_, F.col("trait"))
    whole = seen.groupBy("kind", "value").agg(F.min(gender).alias("low"), F.max(gender).alias("high"), F.min("trait").alias("least"))
    name = F.when(open_ & (F.col("low") == F.col("high")), F.col("low")).otherwise(F.col("trait"))
    return seen.join(whole, ["kind", "value"]).select("kind", "value", "trait", F.when(
        F.col("kind").isin("given", "family"), name).otherwise(F.col("least")).alias("who"))


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """``docs(doc_id, text)`` with entities replaced: ``(doc_id, text, n_entities, kinds)``.

    ``kinds`` counts the entities by kind.  Null and empty texts stay as they are; repeated rows and null ids are
    treated by their text; an empty table gives no rows.  Other columns are not read.
    """
    home = workspace(docs.sparkSession, "surrogates")
    # a row is told by id and text, so that repeated and null ids do no harm
    docs = docs.select("doc_id", "text", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("?")),
                                                                F.lit(":"), "text"))).alias("rid"))
    found = kept(mentions(kept(entities_in(docs), f"{home}/matches")), f"{home}/mentions")
    names = kept(settled(found.select("kind", "value", "trait").distinct()), f"{home}/names")
    table = surrogates(names.select("kind", "value", F.col("who").alias("trait")).distinct(), key, home)
    table = names.join(table.withColumnRenamed("trait", "who"), ["kind", "value", "who"]).drop("who")
    told = found.join(table, ["kind", "value", "trait"])
    titled = F.regexp_extract("match", rf"^((?:{TITLE})\.?\x20)", 1)
    text = F.when(F.col("kind").isin("given", "family"), F.concat(F.when(F.col("j") == 0, titled).otherwise(" "), F.when(
        F.regexp_like("match", F.lit(r"\p{Ll}")), F.initcap("surrogate")).otherwise(F.upper("surrogate")))).otherwise(_rendered(F.col("match"), F.col("kind"), F.col("surrogate")))
    counted = F.when(F.col("kind").isin("given", "family"), "person").otherwise(F.col("kind"))
    parts = told.groupBy("rid", "i").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", text.alias("s")))),
                                                                  lambda x: x["s"]), "").alias("s"), F.min(counted).alias("kind"))
    rows = parts.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("i", "s"))).alias("new"),
                                    F.collect_list("kind").alias("kinds"))
    matches = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    between = F.split("text", ANY, -1)
    glued = F.array_join(F.transform(between, lambda s, i: F.when(i == 0, s).otherwise(F.concat(F.coalesce(
        F.element_at("new", i - 1), F.element_at(matches, i)), s))), "")
    out = docs.join(rows.hint("shuffle_hash"), "rid", "left")
    kinds = F.coalesce("kinds", F.array().cast("array<string>"))
    return out.select("doc_id", F.when(F.col("new").isNull(), F.col("text")).otherwise(glued).alias("text"),
                      F.size(kinds).cast("long").alias("n_entities"),
                      F.map_from_entries(F.array(*[F.struct(F.lit(k), _count(kinds, k)) for k in FORMS])).alias("kinds"))
