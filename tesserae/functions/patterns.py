"""Patterns and word lists that results depend on.

Patterns are written for Java's regex; classes are spelt out, since \\w, \\d, \\s and \\b
differ between dialects.
"""

from __future__ import annotations

import re

# Printf-like specs in three grammars (checker, gate, masker).
SPEC = r"[-+#0]*\d*(?:\.\d+)?[sdfucxXobeEgG]"
PRINTF = rf"%(?:(?:\d+\$)?{SPEC}|%)"
LEAK = rf"%(?:\d+\$)?{SPEC}[A-Za-z]"
GATE_PRINTF = r"%(?:\d+\$)?[sdfucxXob]|%%"
MASK_TOKEN = r"%(?:\d+\$)?[sdfucxXob]|%%|\$[A-Za-z_][A-Za-z0-9_]*|\{[^{}]*\}"

# Forms in which a numbered sentinel leaks out of machine translation, in the order in which they are mended.
SENTINEL_LEAKS = [
    r"ZZ(\d+)ZZ", r"ZZ(\d+)Z", r"Z(\d+)ZZ+", r"Z(\d+)Z", r"ZZ(\d+)",
    r'"\s*\u2022?\s*(\d+)\s*\u2022?\s*"', r"\u2022\s*(\d+)", r"(\d+)\s*\u2022", r'"(\d+)"',
]
# Code points that a translation has only by accident (music notes, mathematical alphanumerics, box drawing, geometric
# shapes, miscellaneous symbols but for ballot boxes, dingbats), and Greek.
ARTIFACTS = r"[\x{2669}-\x{266F}\x{1D400}-\x{1D7FF}\x{2500}-\x{257F}\x{25A0}-\x{25FF}\x{2600}-\x{260F}\x{2613}-\x{26FF}\x{2700}-\x{27BF}]"
GREEK = r"[\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}]"

# Markup, bracket tokens, identifiers.
TAG_NAMES = "code|strong|em|b|i|u|a|br|p|span|div|ul|ol|li|small|sup|sub"
TAG = rf"(?i)</?(?:{TAG_NAMES})(?:[^\p{{L}}\p{{N}}_<>][^<>]*)?>"
TOKEN = r"\[[A-Z0-9_]+\]"
IDENTIFIER = (
    r"(?<![\p{L}\p{N}_])(?:[a-z][a-z0-9]*+(?:_[a-z0-9]++)++|(?:dns|api|misc|db|ldap|mail|pdns)\.[a-z_.]+"
    r"|[\p{L}\p{N}_-]++\.(?:php|html|twig|js|css|sql|dat|json|ya?ml|conf|ini))(?![\p{L}\p{N}_])"
)

def ordinary_run(but: tuple[str, ...] = ()) -> str:
    """A pattern for a run of words of Latin letters, the first alone a capital, between white space: they hold no digit, sign, acronym, name of a record or letter of
    another script. With `but`, words are of ASCII letters and none begins with one of these, whatever its case."""
    by_letter: dict[str, list[str]] = {}
    for word in sorted({w.lower() for w in but if w}):
        by_letter.setdefault(word[0], []).append(re.escape(word[1:]))
    none_of = "(?!(?i:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in by_letter.items()) + "))" if by_letter else ""
    first, rest = ("A-Z", "a-z") if but else (r"A-Z\x{C0}-\x{D6}\x{D8}-\x{DE}", r"a-z\x{DF}-\x{F6}\x{F8}-\x{FF}")
    return rf"(?<!\S)(?:{none_of}[{first}]?+[{rest}]+[.,;!?]?+[ \t\n\r]+)++"


# Numbers, ranges, addresses, masks, names.
NUMBER = "\\d{1,3}(?:[.,\u00a0\u202f\u2009 ]\\d{3})+(?:[.,]\\d+)?|\\d+[.,]\\d+|\\d+"
RANGE = "(\\d+)[ \\t\\n\\r]*[-\u2010-\u2015][ \\t\\n\\r]*(\\d+)"
NUMBER_STRIP = (
    r"(?i)(?:https?://|www\.)\S+"
    r"|%(?:\d+\$)?[-+#0]*\d*(?:\.\d+)?[a-zA-Z]"
    r"|(?<![\p{L}\p{N}_])[A-Za-z]+[0-9][A-Za-z0-9]*(?![\p{L}\p{N}_])"
    r"|(?<![\p{L}\p{N}_])[A-Za-z]+-[0-9][A-Za-z0-9-]*(?![\p{L}\p{N}_])"
    r"|(?<![\p{L}\p{N}_])[0-9]+[A-Za-z]+(?![\p{L}\p{N}_])"
    r"|(?<![0-9A-Za-z.])\d{1,3}(?:\.\d{1,3}){3}(?:/\d{1,2})?"
    r"|(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?:/\d{1,3})?"
)
CITATION = "(?i)(?<![\\p{L}\\p{N}_])(rfc|bcp|std)[\\s\u2010-\u2015-]+(?=\\d)"
IPV4 = r"(?<![0-9A-Za-z.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?:/\d{1,2})?(?![0-9A-Za-z]|\.[0-9A-Za-z])"
DOTTED = r"(?<![0-9A-Za-z.])\d{1,3}(?:\.\d{1,3}){1,3}(?:/\d{1,3})?(?![0-9A-Za-z]|\.[0-9A-Za-z])"
COLONHEX = r"(?<![0-9A-Za-z:])(?=[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){1,7}(?:/\d{1,3})?(?![0-9A-Za-z:])"
FORMAT_MASK = r"(?<![A-Za-z0-9])[YMDHmSxn]{2,}(?:[:-][YMDHmSxn]{2,})*(?![A-Za-z0-9])"
SIGNIFICANT = r"(?<![A-Za-z0-9])(?:[A-Z][A-Za-z0-9]{2,}|\d+)(?![A-Za-z0-9])"
ACRONYM = r"(?<![A-Za-z0-9])[A-Z][A-Z0-9]{2,}(?![A-Za-z0-9])"
UPPER_RUN = r"(?<![A-Za-z0-9])[A-Z][A-Z0-9]+(?![A-Za-z0-9])"
LATIN_WORD = r"(?<![A-Za-z0-9])[A-Za-z]{4,}(?![A-Za-z0-9])"
ENGLISH_WORD = r"[A-Za-z']+"
LEAK_STRIP = (
    r"<[^<>]*>|\[[A-Z0-9_]+\]|%(?:\d+\$)?[-+#0]*\d*(?:\.\d+)?[a-zA-Z]|%%"
    r"|(?:https?://|www\.)\S+|[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+|/\S+"
    r"|[a-zA-Z][a-zA-Z0-9]*(?:[_-][a-zA-Z0-9]+)+"
    "|\"[^\"]*\"|'[^']*'|[\u201c\u201d][^\u201c\u201d]*[\u201c\u201d]"
    r"|\([^()]*\)"
)
BOILERPLATE = (
    r"(?i)(?<![\p{L}\p{N}_])(?:tweet|tweets|retweet|twitter|facebook|instagram|wikipedia|accessdate"
    r"|hashtag|opensubtitles|addic7ed|yify|synced by|ripped by)(?![\p{L}\p{N}_])"
    "|دانلود بازی|دانلود زیرنویس|دانلود فیلم|زیرنویس فارسی|titrat u sollen"
)
WIKI_CHROME = r"\[[^\[\]]*\|[^\[\]]*\]"
QUESTION_OPENER = r"(?i)^(?:are|is|do|does|did|can|could|will|would|should|have|has)(?![\p{L}\p{N}_])"

# Names that survive translation, and words that end no sentence.
RECORD_TYPES = "SOA CNAME AAAA CAA DNSKEY RRSIG NSEC NSEC3 TLSA SSHFP NAPTR HINFO SPF DKIM DMARC TSIG DNSSEC SVCB ZONEMD EUI48 EUI64 IPSECKEY OPENPGPKEY SMIMEA CSYNC DHCID TXT SRV PTR MX".split()
STOPWORDS = "The And For You Not This That Use Using Please Only All Each New".split()
ORDINARY_CAPS = "ALIAS ALL ALLOW BEGIN CERT COUNTER CRITICAL DEPRECATED DOMAIN EDIT END EXPERIMENTAL FROM GET HOSTMASTER IMPORTANT KEY LOC MAIL MUST NATIVE NO NOT NOTE NOTIFY OK ONCE ORIGIN POST PRIVATE PUBLIC RECOMMENDED REQUIRE RP SEP SERIAL SERVER SHOULD SIG STRONGLY TYPE URI WARNING ZONE".split()
FRAGMENT_TAIL = "a an the and or of to for in on at by with from into as is are be was were than that this these those about over under between per".split()
ENGLISH_NEGATION = "not no never none cannot can't don't doesn't won't isn't aren't wasn't weren't shouldn't couldn't wouldn't hasn't haven't didn't without nor neither nothing".split()
# Ordinary English of an interface that is no term of art, which a text in another script should not hold.
PROSE = """about addresses authentication before cannot changed checked configuration configure credentials dashboard disable disabled display
download edit editing emails enable enabled enter existing expected guidelines information invalid layer login logins logout logs management misses missing
must options password permission permissions please preview properties queried recovery rejected review security selected selection session settings unknown
updated username users zones""".split()
# English negation, and spans in which its words are literals.
ENGLISH_NEGATED = (
    r"(?i)(?<![A-Za-z'])(?:n(?:ot|o|ever|or|either|othing)|c(?:annot|an't|ouldn't)|w(?:ithout|on't|ouldn't|asn't|eren't)|d(?:on't|oesn't|idn't)|isn't|aren't|shouldn't|ha(?:sn't|ven't))(?![A-Za-z'])"
)
ENGLISH_LITERAL = (
    "\"[^\"]*\"|'[^']*'|[\u201c\u201d][^\u201c\u201d]*[\u201c\u201d]" r"|(?<![\p{L}\p{N}_])[\p{L}\p{N}_]+=[\p{L}\p{N}_]+"
    r"|(?<![\p{L}\p{N}_])[a-zA-Z][a-zA-Z0-9]*(?:[_-][a-zA-Z0-9]+)+(?![\p{L}\p{N}_])"
)
POLAR_PREFIXES = "un in dis".split()
NOT_POLAR = "der less like port able direction line".split()
POLAR_PAIRS = [
    ("enable", "disable"), ("enabled", "disabled"), ("enabling", "disabling"), ("show", "hide"), ("shown", "hidden"),
    ("showing", "hiding"), ("add", "remove"), ("added", "removed"), ("adding", "removing"), ("activate", "deactivate"),
    ("activated", "deactivated"), ("activating", "deactivating"), ("active", "inactive"),
]
MORPH_PAIRS = [("has", "have"), ("is", "are"), ("this", "these"), ("that", "those"), ("was", "were"), ("doe", "do"), ("it", "them"), ("wa", "were")]
SYNONYM_PAIRS = [("delete", "remove"), ("deleted", "removed"), ("deleting", "removing")]
CJK_LOCALES = "zh_CN zh_TW ja_JP ko_KR".split()

# Look-alike letters of other scripts, and their phonetic forms.
HOMOGLYPHS = ("АВСЕНІЈКМОРЅТУХΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABCEHIJKMOPSTYXABEZHIKMNOPTYX")
PHONETIC = ("АБВГДЕЗИЙКЛМНОПРСТУФЫЭ", "ABVGDEZIYKLMNOPRSTUFYE")
CAPITAL_RUN = "[А-ЯЁЀ-ЏΑ-Ω]{3,}"

# The script that a locale's catalogue is written in.
SCRIPTS = {
    "ar_SA": r"\p{IsArabic}", "fa_IR": r"\p{IsArabic}", "he_IL": r"\p{IsHebrew}", "el_GR": r"\p{IsGreek}",
    "bg_BG": r"\p{IsCyrillic}", "ru_RU": r"\p{IsCyrillic}", "uk_UA": r"\p{IsCyrillic}", "sr_RS": r"\p{IsCyrillic}",
    "hi_IN": r"\p{IsDevanagari}", "th_TH": r"\p{IsThai}", "ja_JP": r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}",
    "ko_KR": r"\p{IsHangul}\p{IsHan}", "zh_CN": r"\p{IsHan}", "zh_TW": r"\p{IsHan}",
}
