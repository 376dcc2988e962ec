"""Small default lexicons, written independently of any test corpus.

All of them are parameters: pass your own rows (a list of tuples or a DataFrame with the same
columns).  ``lang`` is a language code, or ``*`` for "any language".
"""

from __future__ import annotations

import re

from modspark.fixed_values import POLICY

# (lang, word): frequent function words, the evidence used by language ranking.
LANGUAGE_PROFILES = [
    (lang, word)
    for lang, words in {
        "en": "the of and to is that it was for with this are be by on",
        "de": "der die und den von zu das mit sich für ist nicht dem ein auf",
        "fr": "le la les et des du une est pour qui dans sur pas avec au",
        "es": "el los las que y del se por con una para es su no al",
    }.items()
    for word in words.split()
]

# (lang, required characters, excluded characters): languages told apart by script.  The score
# counts the required characters when no excluded character is present.
SCRIPT_PROFILES = [
    ("ja", r"[\x{3040}-\x{30ff}\x{4e00}-\x{9fff}]", None, r"[\x{3040}-\x{30ff}]"),
    ("zh", r"[\x{4e00}-\x{9fff}]", r"[\x{3040}-\x{30ff}]", None),
    ("ko", r"[\x{ac00}-\x{d7af}]", None, None),
    ("ru", r"[\x{0400}-\x{04ff}]", None, None),
]

# (class, word, lang)
SENTIMENT_LEXICON = [
    (polarity, word, lang)
    for polarity, lang, words in [
        ("positive", "en", "good great happy love excellent wonderful nice pleasant glad enjoy "
                           "beautiful kind thanks best hope delightful"),
        ("negative", "en", "bad sad unhappy hate terrible awful horrible angry worst destroy "
                           "ugly disgusting pathetic worthless stupid confuses"),
        ("positive", "de", "gut schön glücklich liebe wunderbar toll freude danke"),
        ("negative", "de", "schlecht traurig hasse schrecklich wütend furchtbar hässlich"),
        ("positive", "fr", "bon heureux aime merveilleux excellent merci joli"),
        ("negative", "fr", "mauvais triste déteste terrible horrible affreux laid"),
        ("positive", "es", "bueno feliz amo maravilloso excelente gracias bonito"),
        ("negative", "es", "malo triste odio terrible horrible feo enojado"),
    ]
    for word in words.split()
]

# (category, word, lang)
TOXICITY_LEXICON = [
    (category, word, "en")
    for category, words in {
        "profanity": "damn crap bloody bastard",
        "hate_speech": "subhuman vermin infidel",
        "sexual": "porn nude naked erotic",
        "insult": "idiot moron stupid loser clown scum trash pathetic worthless dumb fool",
        "violence_or_threat": "kill murder destroy attack shoot stab bomb",
        "graphic": "gore blood corpse mutilated",
        "harassment_or_abuse": "harass stalk bully threaten abuse",
    }.items()
    for word in words.split()
]

# (type, pattern, score, literal or [class] that every match contains, or None).  Group 1 is a cue that does not
# belong to the entity, group 2 the entity, which ends the match.  What must not stand before a match
# is tested after its first character, so that the search is for that character.
PII_PATTERNS = [
    ("EMAIL", r"()([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})", 1.0, "@"),
    ("PHONE", r"()([+1](?<![0-9+][+1])(?:(?<=\+)[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}"
              r"|(?<=1)[0-9]{10})(?![0-9]))", 1.0, "[0-9]"),
    ("IP_ADDRESS", r"()([0-9](?<![0-9.][0-9])[0-9]{0,2}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]))",
     1.0, "[0-9]"),
    ("CREDIT_DEBIT_NUMBER", r"()([0-9](?<![0-9]{2})[0-9]{15}(?![0-9]))", 1.0, "[0-9]"),
    ("NAME", r"([Mm](?<!\p{L}[Mm])(?i:y name is) +)(\p{Lu}[\p{L}'-]*(?: \p{Lu}[\p{L}'-]*)*)", 1.0, None),
    ("NAME", r"(我叫)([\x{4e00}-\x{9fff}]{2,4})", 1.0, "我叫"),
    ("AGE", r"([IiAa](?<!\p{L}[IiAa])(?:(?<=[Ii])(?: am|'m)|(?<=[Aa])ged?) )"
            r"([0-9]{1,3}(?![0-9])(?: years(?= old))?)", 1.0, "[0-9]"),
    ("AGE", r"()([0-9](?<![0-9]{2})[0-9]{0,2}(?=岁))", 1.0, "岁"),
]


def phrase_of(words: str) -> str:
    """Normal form of a policy phrase: lower-case letter runs joined by one blank."""
    return " ".join(w for w in re.split(r"[^\w]|[\d_]", words.lower()) if w)


# (category_no, category, phrase, lang)
POLICY_PHRASES = [
    (number, category, phrase_of(sub), "en")
    for number, (category, subs) in enumerate(POLICY, start=1)
    for sub in subs
]

# Languages written without blanks between words: stems are found anywhere in a text.
UNSPACED = ("ja", "ko", "th", "zh")

# (category_no, category, stem, lang): beginnings of words that prose uses for what the policy names.
# Pass them as ``stems``; stems that begin harmless words (stab-le, shot-gun wedding) are left out.
POLICY_STEMS = [
    (number, POLICY[number - 1][0], stem, lang)
    for number, lang, stems in [
        (1, "en", "nude nudit naked porn"), (1, "de", "nackt porn"), (1, "fr", "nudité porn"), (1, "es", "desnud porn"),
        (1, "zh", "裸体 色情"),
        (2, "en", "lingerie topless"), (2, "de", "dessous"), (2, "fr", "lingerie"), (2, "es", "lencería"),
        (3, "en", "kill murder destroy massacr slaughter behead strangl tortur"),
        (3, "de", "töte ermord zerstör massak folter"), (3, "fr", "tuer meurtr détrui massacr tortur"),
        (3, "es", "matar asesin destru masacr tortur"), (3, "zh", "毁灭 杀死 杀人 屠杀 自杀 酷刑"),
        (4, "en", "corpse explosion bombing"), (4, "de", "leiche explosion"), (4, "fr", "cadavre explosion"),
        (4, "es", "cadáver explosión"), (4, "zh", "尸体 爆炸"),
        (6, "en", "cocain heroin methamphet"), (6, "de", "kokain heroin"), (6, "fr", "cocaïn héroïn"),
        (6, "es", "cocaín heroín"), (6, "zh", "毒品 海洛因"),
        (7, "en", "cigarett tobacco"), (7, "de", "zigarett tabak"), (7, "fr", "cigarett tabac"), (7, "es", "cigarr tabaco"),
        (7, "zh", "香烟 吸烟"),
        (8, "en", "whisk vodka drunk"), (8, "de", "schnaps betrunken"), (8, "fr", "ivrogn"), (8, "es", "borrach"), (8, "zh", "喝酒 醉酒"),
        (9, "en", "gambl casino"), (9, "de", "glücksspiel casino"), (9, "fr", "casino"), (9, "es", "apuesta casino"), (9, "zh", "赌博"),
        (10, "en", "nazi supremacis"), (10, "de", "nazi"), (10, "fr", "nazi"), (10, "es", "nazi"), (10, "zh", "纳粹"),
    ]
    for stem in stems.split()
]
