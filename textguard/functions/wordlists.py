"""Word lists, phrases and patterns. Every operator takes its own
list as a parameter as well; these are the defaults."""

from __future__ import annotations

from typing import NamedTuple


class Entry(NamedTuple):
    """A weighted word (lower case) or, with ``phrase``, a weighted pattern."""

    term: str
    weight: float
    phrase: bool = False


# Scored categories.
TOXIC = [
    Entry("idiot", 1.0),
    Entry("stupid", 1.0),
    Entry("moron", 1.0),
    Entry("trash", 1.0),
    Entry("scum", 1.0),
    Entry("clown", 1.0),
    Entry("worthless", 1.0),
    Entry("pathetic", 1.0),
    Entry("loser", 1.0),
    Entry("disgusting", 1.0),
]
NSFW = [Entry("shit", 1.0), Entry("fucking", 1.0), Entry("dickhead", 1.0)]
PROFANITY = ["shit", "fucking", "dickhead"]
TOPICS = {
    "violence": [
        Entry("violence", 1.0),
        Entry("violent", 1.0),
        Entry("aggression", 0.5),
        Entry("fights", 0.5),
    ],
}
BIAS = [
    Entry("ethnic groups", 0.5, phrase=True),
    Entry("stereotypes", 0.3, phrase=True),
    Entry("crime rates", 0.3, phrase=True),
]
NEGATIVE = [
    "failures", "setbacks", "disappointment", "despair", "gloom", "darkness",
    "unsettling", "doubts", "struggling",
]
POSITIVE = ["strong", "growth", "liquidity", "great", "love", "good"]
INJECTION = [
    Entry("everything above was wrong", 0.6, phrase=True),
    Entry(r"(?:ignore|disregard|forget) [^\n]{0,40}(?:previous|prior|above)", 0.8, phrase=True),
    Entry(r"(?:print|show|reveal|repeat) [^\n]{0,40}instructions", 0.6, phrase=True),
]
REFUSAL = [
    Entry(r"i can(?:no|')t (?:assist|help)", 0.8, phrase=True),
    Entry(r"i(?:'m| am) (?:sorry|unable)", 0.6, phrase=True),
    Entry("as an ai", 0.5, phrase=True),
]
MANIPULATION = [
    Entry("psychological condition", 0.5, phrase=True),
    Entry("swear at me", 0.5, phrase=True),
    Entry("respect my condition", 0.5, phrase=True),
    Entry("harsh and impolite", 0.5, phrase=True),
]

# Function words by language.
FUNCTION_WORDS = {
    "de": ["der", "die", "und", "ich", "nicht", "danke", "das", "ist"],
    "en": ["the", "and", "of", "to", "you", "thank", "this", "is", "in", "that"],
    "es": ["el", "los", "que", "una", "por", "de", "y", "gracias"],
    "fr": ["le", "la", "les", "des", "et", "que", "est", "pas"],
}

# Lines of source code by language.
CODE_LINES = {
    "Python": [
        r"^[ \t]*(?:def|class) [A-Za-z0-9_]+.*:[ \t]*$",
        r"^[ \t]*(?:for|while|if|elif|else|with|try|except).*:[ \t]*$",
        r"^[ \t]*(?:import|from) [A-Za-z0-9_]+",
        r"^[ \t]*return(?:[^A-Za-z0-9_]|$)",
        r"^[ \t]*[A-Za-z_][A-Za-z0-9_.]* ==? .+\)[ \t]*$",
        r"^[ \t]*[A-Za-z_][A-Za-z0-9_.]*\(.*\)[ \t]*$",
    ],
}

# Currencies by ISO code and sign.
CURRENCIES = {"EUR": "€", "GBP": "£", "JPY": "¥", "USD": "$"}

# English stop words used when tokenizing field names.
KEY_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now cannot could ought would
""".split()

# Words left out of a standardized name.
NAME_STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
]


class PiiRule(NamedTuple):
    """One kind of personal data. ``edges`` asks for ASCII word edges around the
    pattern, ``{edge}`` for one such edge inside it; ``lead`` is a cue before the
    value that must stay in the text. ``needs`` is a cheap pattern without which
    there is no hit."""

    entity: str
    pattern: str
    edges: bool = True
    lead: str = ""
    needs: str = "[0-9]"


# Personal data, in the order in which the rules apply. Host names and
# names of any length are matched by classes or possessive groups, which the JVM
# matches in a loop; an endless ordinary group would exhaust its stack. A match of host
# characters begins at the head of their run, so that a long run is looked at once.
PII_RULES = [
    PiiRule(
        "EMAIL",
        r"(?<![A-Za-z0-9_])(?<![A-Za-z0-9_][.%+-]{1,64})[A-Za-z0-9_][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++"
        r"(?:\.-*+[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+)++(?![A-Za-z0-9_])",
        edges=False,
        needs="@",
    ),
    PiiRule(
        "SECRET",
        r'(?i:bearer [A-Za-z0-9._~+/-]+|token = "[0-9a-f]{40}")',
        edges=False,
        needs="(?i)bearer |token = ",
    ),
    PiiRule("URL", r'https?://[^ \t\n\r\f<>"]+', needs="https?://"),
    PiiRule(
        "DOMAIN",
        r"[A-Za-z0-9][A-Za-z0-9.-]*(?<=[A-Za-z0-9-])\.(?:com|org|net|site|io)(?![A-Za-z0-9_])",
        edges=False,
        lead=r"(?<![A-Za-z0-9.-])[.-]*+",
        needs=r"\.(?:com|org|net|site|io)",
    ),
    PiiRule("IP", r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"),
    PiiRule("IBAN", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"),
    PiiRule("CRYPTO", r"[13][A-HJ-NP-Za-km-z1-9]{25,34}"),
    PiiRule("CREDIT_CARD", r"[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}"),
    PiiRule("SSN", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    PiiRule(
        "PHONE",
        r"(?:\+1 )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}|{edge}[0-9]{3}[- ][0-9]{3}[- ][0-9]{4}{edge}|{edge}[0-9]{10}{edge}",
        edges=False,
    ),
    PiiRule("BANK_ACCOUNT", r"[0-9]{12}"),
    PiiRule("PASSPORT", r"[0-9]{9}"),
    PiiRule("DRIVER_LICENSE", r"[0-9]{7}[A-Z]"),
    PiiRule(
        "DATE",
        r"(?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2}",
    ),
    PiiRule(
        "PERSON",
        r"[A-Z][a-z]+(?: [A-Z][a-z]+)*+",
        edges=False,
        lead="(?i:my name is )",
        needs="(?i)name is ",
    ),
]

# Names that other tools give to these entities.
PII_ALIASES = {
    "EMAIL_ADDRESS": "EMAIL",
    "PHONE_NUMBER": "PHONE",
    "IP_ADDRESS": "IP",
    "IBAN_CODE": "IBAN",
    "US_SSN": "SSN",
    "US_PASSPORT": "PASSPORT",
    "US_DRIVER_LICENSE": "DRIVER_LICENSE",
    "US_BANK_NUMBER": "BANK_ACCOUNT",
    "DATE_TIME": "DATE",
    "DOMAIN_NAME": "DOMAIN",
}

# Named groups of personal data.
PII_GROUPS = {
    "pii": [rule.entity for rule in PII_RULES if rule.entity != "SECRET"] + ["LOCATION"],
    "spi": [
        "IBAN", "CRYPTO", "CREDIT_CARD", "SSN", "BANK_ACCOUNT", "PASSPORT", "DRIVER_LICENSE",
    ],
}
