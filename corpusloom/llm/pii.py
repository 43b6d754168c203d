"""Operator 7, surrogates for personal data (SQL functions only, no shuffle).

Entities (mail and network addresses, account, card, phone and social security numbers, names after a title, and other
mentions of such names in the same text) get keyed replacements of the same type and format. An entity's canonical value is permuted, and what comes out is written
back in the format found: numbers by their letters and digits alone, whatever stands between them (of a phone number the national part; its
calling code stays); mail addresses and names without regard to case, letter by letter in the case found. So `+1 (366) 555-9807`, `+1-366-555-9807` and
`366-555-9807` have one surrogate in three formats, and so have `Maria`, `MARIA` and `maria`. Local part and domain of a mail address are
permuted apart, and every part of a name by itself, so that `Mrs Maria Lopez`, `Mrs Lopez` and `Maria` agree, and two addresses at one domain stay together.

The permutation is keyed: the two halves of the characters pass a four-round Feistel network in which each character moves
within its own alphabet (digits; letters; in names vowels and consonants of one script) and all others
stay; then the first character that has an alphabet goes one step on, and the rounds are undone. Such a
permutation leaves no value as it is. So the same value has the same surrogate in all documents, under one key, and two
values of a type and length never share one, whatever the corpus's size; no table of entities has to be gathered or joined. Kept are: a mail
address's top-level domain, calling codes and an account's country code, a card's first digit and whether its check digit is right, a
name's title, the last two letters of each of its parts from four letters on (of shorter ones the last), by which given names of most
languages served tell gender, and all punctuation.

A part of a titled name is replaced wherever it stands as a word of the same text, in any case, with a title or without: rather a plain word too many (`brown`, where
there is a `Mr Brown`) than a name too few. Names of which no mention in the text has a title are not found.

The checks of every row count, in that text, values whose surrogate is another value's too, and values with two surrogates (`collisions`), and entities left as
they were (`unchanged`: those without a character of a known alphabet); `shared_surrogates` checks all texts together.

Defined cases: a null text stays null with no entities; texts without entities are returned as they are; repeated rows and ties change
alike; an empty table gives an empty result; in `replace` extra columns stay, whatever their names, in `surrogates` they are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns

ROUNDS = 4
#: Titles by gender, in the languages served; those of either gender last.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Dra", "Госпожа", "Κυρία"), "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"), "any": ("Dr", "Prof", "Doctor", "Professor")}
#: Longest first, so that Mrs is not read as Mr.
_TITLE = "(?:" + "|".join(sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t))) + r")\.?"
#: A word of a name, with an apostrophe or a hyphen before another capital; and the parts of it that are permuted by themselves.
_WORD = r"(?:\p{Lu}['’]\p{Lu}\p{L}{1,30}|\p{Lu}\p{L}{1,30})(?:['’-]\p{Lu}\p{L}{1,30})?"
_PART = r"\p{L}+(?:['’]\p{L}+)*"
#: Kinds in the order in which they are tried at a place. Repetitions are bounded or possessive, so that no text makes them slow or deep.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w.+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w])",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "name": rf"(?<![\w]){_TITLE} {_WORD}(?: {_WORD})?",
}
ANY = "|".join(PATTERNS.values())
#: What may not stand beside a mention of a name, for use in a class.
WORD_SIGNS = r"\p{L}\d_"
LETTERS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX_LETTERS = ("0123456789", "abcdef")
#: Vowels and consonants of each script served, in lower case.
NAME_LETTERS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "ñç", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αειουηω", "άέίόύήώ", "βγδζθκλμνξπρστφχψ")
#: Fixed value: telephone calling codes of one, two and three digits.
CALLING_CODE = "(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, then: str) -> str:
    return f"transform(array({value}), {name} -> {then})[0]"


def _hash(key: str, kind: str, salt: str) -> str:
    """16 bits for element i of a half in round r, from the other half `salt`."""
    return f"cast(conv(substring(md5(concat({_text(key + '/' + kind + '/')}, r, '/', {salt}, '/', i div 8)), cast(i % 8 as int) * 4 + 1, 4), 16, 10) as int)"


def _permuted(elements: str, half: str, moved, step: str, salt) -> str:
    """SQL for an array permuted by the rounds, one step (of array x), and the rounds undone.

    moved(n): element c moved by n; salt(x): text of a half.
    """
    halves = lambda x: f"named_struct('a', slice({x}, 1, {half}), 'b', slice({x}, {half} + 1, size({x})))"
    on = f"aggregate(sequence(0, {ROUNDS - 1}), {halves('x0')}, (acc, r) -> named_struct('a', acc.b, 'b', transform(acc.a, (c, i) -> {moved(salt('acc.b'))})), acc -> concat(acc.a, acc.b))"
    undone = f"aggregate(sequence({ROUNDS - 1}, 0, -1), {halves('x2')}, (acc, r) -> named_struct('a', transform(acc.b, (c, i) -> {moved('-' + salt('acc.a'))}), 'b', acc.a), acc -> concat(acc.a, acc.b))"
    return _let(elements, "x0", _let(on, "x", _let(step, "x2", undone)))


def permute(body: str, key: str, kind: str, alphabets: tuple[str, ...]) -> str:
    """SQL for the keyed permutation of a string among those of its format."""
    sets = f"array({', '.join(map(_text, alphabets))})"
    moved = lambda n: f"coalesce(try_element_at(transform(filter({sets}, k -> instr(k, c) > 0), k -> substring(k, pmod(instr(k, c) - 1 + {n}, length(k)) + 1, 1)), 1), c)"
    first = f"array_position(transform(x, c -> exists({sets}, k -> instr(k, c) > 0)), true) - 1"
    step = _let(first, "p", f"transform(x, (c, i) -> if(i = p, {moved('1')}, c))")
    whole = _permuted(f"filter(split({body}, ''), c -> c <> '')", f"cast(length({body}) div 2 as int)", moved, step, lambda x: _hash(key, kind, f"array_join({x}, '')"))
    return f"array_join({whole}, '')"


def _address(e: str, key: str) -> str:
    """SQL for a network address: its numbers, permuted modulo 256."""
    numbers = f"transform(split({e}, '[.]'), n -> cast(n as int))"
    salt = lambda x: _hash(key, "ip", f"array_join(transform({x}, n -> cast(n as string)), '.')")
    whole = _permuted(numbers, "2", lambda n: f"pmod(c + {n}, 256)", "transform(x, (c, i) -> if(i = 3, pmod(c + 1, 256), c))", salt)
    return f"array_join(transform({whole}, n -> cast(n as string)), '.')"


def _check_digit(digits: str) -> str:
    """SQL for the Luhn check digit of a number without it; other characters are passed over."""
    each = f"transform(reverse(split(regexp_replace({digits}, '[^0-9]', ''), '')), d -> d)"
    value = "cast(d as int) * (2 - i % 2) - if(cast(d as int) * (2 - i % 2) > 9, 9, 0)"
    return f"((10 - aggregate(transform(filter({each}, d -> d <> ''), (d, i) -> cast({value} as int)), 0, (s, x) -> s + x) % 10) % 10)"


def _folded(e: str) -> str:
    """SQL for a text in lower case, or as it is where that has another length."""
    return f"if(length(lower({e})) = length({e}), lower({e}), {e})"


def _cased(new: str, e: str) -> str:
    """SQL for `new` (bound) in the case of e, which is as long, letter by letter."""
    return f"array_join(transform(filter(split({e}, ''), c -> c <> ''), (c, i) -> if(c <> lower(c), upper(substring({new}, i + 1, 1)), substring({new}, i + 1, 1))), '')"


def _bare(e: str) -> str:
    """SQL for the letters and digits of a number."""
    return f"regexp_replace({e}, '[^0-9A-Za-z]', '')"


def _written(new: str, e: str) -> str:
    """SQL for e with its letters and digits replaced, one after the other, by those of `new` (bound)."""
    upto = _bare(f"substring({e}, 1, i + 1)")
    return f"array_join(transform(filter(split({e}, ''), c -> c <> ''), (c, i) -> if(c rlike '[0-9A-Za-z]', substring({new}, length({upto}), 1), c)), '')"


def part(p: str, key: str) -> str:
    """SQL for the surrogate of one part of a name, in its case; its last two letters stay, of less than four the last."""
    kept = f"if(length({p}) < 4, 1, 2)"
    whole = _let(_folded(p), "w0", f"concat({permute(f'substring(w0, 1, length(w0) - {kept})', key, 'name', NAME_LETTERS)}, right(w0, {kept}))")
    return _let(whole, "w1", _cased("w1", p))


def _by_parts(words: str, new: str) -> str:
    """SQL for words whose parts w become `new`."""
    pattern = _text(_PART)
    return f"array_join(zip_with(split({words}, {pattern}, -1), transform(regexp_extract_all({words}, {pattern}, 0), w -> {new}), (g, n) -> concat(g, coalesce(n, ''))), '')"


def _national(e: str) -> str:
    """SQL for the national digits of a phone number: those after the calling code, if it has one, or after NANP's 1."""
    return f"if(left({e}, 1) = '+', regexp_replace({_bare(e)}, '^{CALLING_CODE}', ''), {_bare(e)})"


def surrogate(e: str, key: str) -> str:
    """SQL for the surrogate of the entity in column or lambda variable `e`."""
    kept = lambda keep: f"regexp_extract({e}, {_text(keep)}, 0)"
    local, domain = f"substring_index({e}, '@', 1)", f"regexp_replace(substring_index({e}, '@', -1), '[.][^.]*$', '')"
    mixed = lambda x, kind: _let(_let(f"lower({x})", "m0", permute("m0", key, kind, LETTERS)), "m1", _cased("m1", x))
    email = f"concat({mixed(local, 'local')}, '@', {mixed(domain, 'domain')}, {kept('[.][^.]*$')})"
    whole = lambda kind, drop, letters=LETTERS: f"concat(left({_bare(e)}, {drop}), {permute(f'substring({_bare(e)}, {drop} + 1)', key, kind, letters)})"
    digits = _bare(e)
    renewed = f"concat(left({digits}, 1), {permute(f'substring({digits}, 2, length({digits}) - 2)', key, 'card', LETTERS)})"
    was = f"left({digits}, length({digits}) - 1)"
    card = _let(renewed, "q", f"concat(q, ({_check_digit('q')} + cast(right({digits}, 1) as int) - {_check_digit(was)} + 10) % 10)")
    national = _national(e)
    phone = _let(national, "n0", f"concat(left({digits}, length({digits}) - length(n0)), {permute('n0', key, 'phone', LETTERS)})")
    back = lambda new: _let(new, "q1", _written("q1", e))
    ipv6 = _let(f"lower({e})", "v0", permute("v0", key, "ipv6", HEX_LETTERS))
    ipv6 = _let(ipv6, "v1", f"if({e} = lower({e}), v1, upper(v1))")
    title = f"^{_TITLE} "
    name = f"concat({kept(title)}, {_by_parts(f'regexp_replace({e}, {_text(title)}, {_text(str())})', part('w', key))})"
    is_a = lambda kind: f"{e} rlike {_text('^(?:' + PATTERNS[kind] + ')$')}"
    return f"CASE WHEN {is_a('email')} THEN {email} WHEN {is_a('ip')} THEN {_address(e, key)} WHEN {is_a('ipv6')} THEN {ipv6} WHEN {is_a('iban')} THEN {back(whole('iban', '2'))} WHEN {is_a('card')} THEN {back(card)} WHEN {is_a('phone')} THEN {back(phone)} WHEN {is_a('ssn')} THEN {back(whole('ssn', '0'))} ELSE {name} END"


def canonical(e: str) -> str:
    """SQL for what tells an entity from others of its kind, whatever its format: the kind, and its value."""
    is_a = lambda kind: f"{e} rlike {_text('^(?:' + PATTERNS[kind] + ')$')}"
    words = f"regexp_replace({e}, {_text('^' + _TITLE + ' ')}, '')"
    number = " ".join(f"WHEN {is_a(k)} THEN concat('{k} ', {_national(e) if k == 'phone' else _bare(e)})" for k in ("iban", "card", "phone", "ssn"))
    return f"CASE WHEN {is_a('email')} OR {is_a('ip')} OR {is_a('ipv6')} THEN lower({e}) {number} ELSE concat('name ', {_folded(words)}) END"


def _is(kind: str, e: str = "e") -> str:
    """SQL: an entity is of this kind, and of none before it."""
    fits = lambda k: f"{e} rlike {_text('^(?:' + PATTERNS[k] + ')$')}"
    return " and ".join([fits(kind), *(f"not {fits(k)}" for k in list(PATTERNS)[: list(PATTERNS).index(kind)])])


def _rewritten(texts: DataFrame, key: str) -> DataFrame:
    """Add to a column `text`: entities; found, these and, in texts with names, mentions of their parts; new, what takes their place; and rewritten, the text with it."""
    none = F.array().cast("array<string>")
    rows = texts.withColumn("entities", F.coalesce(F.expr(f"regexp_extract_all(text, {_text(ANY)}, 0)"), none))
    words = f"regexp_replace(e, {_text('^' + _TITLE + ' ')}, '')"
    rows = rows.withColumn("parts", F.expr(f"array_distinct(flatten(transform(filter(entities, e -> {_is('name')}), e -> transform(regexp_extract_all({words}, {_text(_PART)}, 0), w -> {_folded('w')}))))"))
    # a pattern of the text's own names, which are letters and apostrophes alone
    mention = f"concat({_text('(?iu:(?<![' + WORD_SIGNS + '])(?:')}, array_join(parts, '|'), {_text(')(?![' + WORD_SIGNS + ']))')})"
    rows = rows.withColumn("pattern", F.expr(f"if(size(parts) = 0, {_text(ANY)}, concat({_text(ANY + '|')}, {mention}))"))
    rows = rows.withColumn("found", F.expr("if(size(parts) = 0, entities, regexp_extract_all(text, pattern, 0))"))
    alone = f"e rlike {_text('^' + _PART + '$')}"
    rows = rows.withColumn("new", F.expr(f"transform(found, e -> CASE WHEN {alone} THEN {part('e', key)} ELSE {surrogate('e', key)} END)"))
    return rows.withColumn("rewritten", F.expr("CASE WHEN size(found) = 0 THEN text ELSE array_join(zip_with(split(text, pattern, -1), new, (g, s) -> concat(g, coalesce(s, ''))), '') END"))


def surrogates(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with surrogates, entities by kind, names repeated without a title, and the checks, of every row."""
    rows = _rewritten(own_columns(docs, "doc_id", "text"), key)
    counts = [F.expr(f"cast(size(filter(entities, e -> {_is(k)})) as long)").alias(f"n_{k}") for k in PATTERNS]
    values = F.expr(f"array_distinct(zip_with(found, new, (a, b) -> named_struct('a', {canonical('a')}, 'b', {canonical('b')})))")
    return rows.withColumn("pairs", values).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("rewritten").alias("text"),
        *counts,
        F.expr(f"cast(size(filter(zip_with(found, new, (e, b) -> e <> b and e rlike {_text('^' + _PART + '$')}), x -> x)) as long)").alias("n_repeat"),
        F.expr("cast(2 * size(pairs) - size(array_distinct(transform(pairs, z -> z.a))) - size(array_distinct(transform(pairs, z -> z.b))) as long)").alias("collisions"),
        F.expr("cast(size(filter(zip_with(found, new, (a, b) -> a = b and array_contains(entities, a)), x -> x)) as long)").alias("unchanged"),
    )


def shared_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """(value, n) of values of the corpus that several values have as their surrogate, or that have several surrogates; none by construction."""
    rows = _rewritten(own_columns(docs, "doc_id", "text"), key).select(F.explode(F.arrays_zip("found", "new")).alias("z"))
    pairs = rows.select(F.expr(canonical("z.found")).alias("a"), F.expr(canonical("z.new")).alias("b")).distinct()
    several = lambda c, kind: pairs.groupBy(F.concat(F.lit(f"{kind}: "), c).alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return several("b", "surrogate").unionByName(several("a", "value"))


def replace(docs: DataFrame, key: str) -> DataFrame:
    """docs with surrogates in `text`, and `n_chars`, where there is one, of the new text; all other columns stay."""
    # the row in a struct beside its text, so that no column can clash with those of the work
    rows = _rewritten(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("`text`").alias("text")), key)
    new = {"text": F.col("rewritten"), "n_chars": F.char_length("rewritten").cast("long")}
    fits = lambda c: c in new and (c != "n_chars" or dict(docs.dtypes)[c] == "bigint")
    return rows.select(F.struct(*((new[c] if fits(c) else F.col("row").getField(c)).alias(c) for c in docs.columns)).alias("out")).select("out.*")
