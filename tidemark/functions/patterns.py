"""Regular expressions shared by the text functions.

Java's ``\\w``, ``\\s`` and ``.`` are narrower than the Unicode classes the text rules are defined on, so the
classes are spelled out. They mean the same in Java and in RE2.
"""

# Unicode word characters and white space.
WORD = r"[\p{L}\p{N}_]"
WS = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}"
SPACES = rf"[{WS}]+"
# The runs that are not already a single blank: replacing only these gives the same text with far fewer
# replacements.
UNEVEN_SPACES = (
    rf"[{WS}]{{2,}}|[\x{{09}}-\x{{0D}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NOT_SPACE = rf"[^{WS}]"

#: The characters of ``WS`` themselves, for ``trim``.
WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# What counts as a URL, a hashtag, a mention, a script block and a tag. Group 1 of URL is
# the domain; group 1 of HASHTAG and MENTION is the name without its sign. The possessive `++` cannot
# change a match here (the path is optional) and keeps long dotted runs off the Java stack.
URL = r"https?://(?:www[^\n])?([\p{L}\p{N}_.\-]+?(?:\.[\p{L}\p{N}_]{2,3})++)(?:/[\p{L}\p{N}_./]+)?"
HASHTAG = rf"#({NOT_SPACE}*{WORD})"
MENTION = rf"@({NOT_SPACE}*{WORD})"
SCRIPT = r"(?iu)<script[^\n]*?/script>"
TAG = r"<[^>\n]*>"
# The same two with tags and scripts allowed to run over line ends.
SCRIPT_MULTILINE = r"(?isu)<script.*?/script>"
TAG_MULTILINE = r"<[^>]*>"

# Fixed value: a character reference as HTML defines it.
CHARREF = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

#: Words: letters only.
LETTERS = r"\p{L}+"
#: A sentence ends at `.`, `!`, `?` or a line end.
SENTENCE = r"[^.!?\n]+[.!?]*"
