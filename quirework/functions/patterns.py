"""Regular expressions of the document format, written so that Java and RE2 read them alike (no look-around, no word bounds)."""

# Fixed values of the document format: item labels and the marks around them.
LABELS = "定义|定理|引理|推论|命题|断言|公理"
LABELS_EN = "Definition|Theorem|Lemma|Corollary|Proposition|Axiom"
STATEMENT = rf"^\*\*(?:{LABELS}|{LABELS_EN})"
STATEMENT_OR_FORMULA = rf"^\*\*(?:{LABELS}|式|{LABELS_EN})"
QUOTED_STATEMENT = rf"^\s*>\s+\*\*(?:{LABELS}|{LABELS_EN})"
QUOTED_PROOF_OF = rf"^\s*>\s+\*\*(?:{LABELS}|{LABELS_EN})[\d.]*的证明"
QUOTED_STATEMENT_CN = rf"^\s*>\s+\*\*(?:{LABELS}|式)"
STATEMENT_CN = rf"^\*\*(?:{LABELS})"
BARE_STATEMENT = r"^\*\*(?:定义|定理|引理|推论|命题|断言)(?:[^\p{L}\p{N}_]|$)"
QUOTE_OPENER = r"^\s*>\s*\*\*(?:证明|证|例|注|说明|Proof|Example|Note|Remark)"
QUOTE_FOOTNOTE = r"^\s*>\s*\^\{"
QUOTE_HEAD = r"^\s*>+\s*\*?(?:\*{0,2})(?:证明|证|例)"
QUOTE_END = r"^(?:---+\s*$|##\s|\*\*[^*]+\*\*|\$\$\s*$)"
QUOTE_LEGIT = r"^\s*>\s*(?:\*\*证明|\*\*例|\*\*注|\^\{)"
QUOTE_WRAPPED = r"^\s*>\s*(?:\$\$|（[0-9a-zA-Z]+）|\*\*\([0-9a-zA-Z]+\)\*\*|- （[0-9a-zA-Z]+）|- \([0-9a-zA-Z]+\))"
QUOTE_MISSING = r"^\s*\*\*(?:证明|证|证明思路|证明概要|注记|说明|Proof|Example|Note|Remark|例(?:\s*\d[\d.]*)?|注(?:\s*\d[\d.]*)?)\*\*"
FOOTNOTE = r"^\s*\{"
NESTED_QUOTE = r"^>\s*>\s*\S"
EMPTY_QUOTE = r"^\s*>\s*$"
EXAMPLE = r"^> \*\*(?:例\*\*|Example(?:\s+\d+)?\*\*)"
#: The same with the number that a label may carry.
EXAMPLE_NUMBERED = r"^> \*\*(?:例[\d.\-]*\*\*|Example(?:\s*[\d.\-]+)?\*\*)"
PROOF = r"^> \*\*(?:证明思路|证明|证明梗概|证明概要)\*\*"
ITEM_EXAMPLE = r"^> \*\*(?:例|Example)"
SUBPOINT = r"^\*\*\(\d+\)\*\*"
LISTED = r"^    (?:\d+\.|\(\d+\))\s"
DASH = r"^---\s*$"
HEADING = r"^#{1,6}\s"
ORDINAL_PAREN = r"^\s*(?:[-*–]\s+)?(?:\*\*)?[（(]([0-9]+|[a-z]+)[)）](?:\*\*)?"
ORDINAL_BOLD = r"^\s*(?:[-*–]\s+)?\*\*([0-9]+|[a-z]+)[.)]\*\*"
ORDINAL_PLAIN = r"^\s{0,3}([0-9]+|[a-z]+)[.)]\s+\S"
ROMAN = r"^m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$"

# Keys of entries, and the canonical form of their labels.
KEY = r"\d+\.\d+[.\-]\d+"
ENTRY = r"\*\*[^*]*?(\d+\.\d+[.\-]\d+)[^*]*\*+"
LABELLED_ENTRY = r"\*\*((?:定义|定理|引理|推论|命题|Definition|Theorem|Lemma|Corollary|Proposition)\s*\d+\.\d+)\s*[.．]?\s*\*+"
LABELLED_MENTION = r"((?:定义|定理|引理|推论|命题|Definition|Theorem|Lemma|Corollary|Proposition)\s*\d+\.\d+)"
CANONICAL = {
    "Definition": "定义", "Theorem": "定理", "Lemma": "引理", "Corollary": "推论", "Proposition": "命题", "Example": "例", "示例": "例",
    "Remark": "评注", "注释": "评注", "注": "评注", "Axiom": "公理", "Assertion": "断言", "Conjecture": "猜想", "Condition": "条件",
    "Assumption": "假设", "假定": "假设", "Algorithm": "算法",
}

# What may not stand outside maths mode.
RAW_ARROWS = "↪↠↦↣→⇒⇔⇐⇎⇏⇉↤↥↮↝↺↻⟶⟼⟻⤇⤊≅"
FENCE_SIGNS = "→↓←↑⇒↘↗↔⟶⟹─│╲╳┼├┤┐└┌┘"
FENCE_TOKENS = ("\\begin", "@>", "@V", "@|", "@AAA", "@<<", "@=", "-->", "<--", "---->", "<----", "-|->", "--|>", "=|>")
NAKED_COMMAND = r"\\[A-Za-z]{2,}"
BAD_MACROS = (r"\\bigl\(\s*\\(?:sup|inf)\s*\\\{", r"\\left\.\\frac")
SWALLOWED_PREFIX = r"^\$\s*(?:>\s*)?(?:[-*]\s+|\([A-Za-z0-9]\)\s+|\d+[.)]\s+)"
EQUATION_NOTE = r"^（式\s*\(\d+\.\d+\)）"
BULLET = r"^\s*-\s*[(（][^)）]+[)）]"
TOP_ITEM = r"^[(（]\d+[)）]"
DEEP_QUOTED_FENCE = r"^\s*>\s{2,}\$\$"
BARE_QUOTED_STATEMENT = rf"^>\s+\*\*(?:{LABELS}|{LABELS_EN})(?:[^\p{{L}}\p{{N}}_]|$)"

# Top-level examples and what ends them, words that open a step of a proof, image lines.
TOP_EXAMPLE = r"^\*\*(?:例(?:[^外如]|$)|Example(?:[^\p{L}\p{N}_]|$))"
TOP_STOP = (
    r"^\*\*(?:定义|定理|引理|推论|命题|断言|公理|注记|注|评注|假设|习题|问题"
    r"|Definition|Theorem|Lemma|Proposition|Corollary|Claim|Axiom|Remark|Assumption|Exercise|Problem|Conjecture)(?:[^\p{L}\p{N}_]|$)"
)
STEP_WORDS = (
    r"(?:首先|其次|再次|然后|接着|最后|先证|再证|次证|又证|后证|另一方面|其一|其二|其三|情形一|情形二|情形三"
    r"|（一）|（二）|（三）|第一步|第二步|第三步|（必要性）|（充分性）|（i）|（ii）|（iii）|（iv）|\(i\)|\(ii\)|\(iii\)|\(iv\))"
)
WEAK_STEP_WORDS = "(?:先|再|又|一般|反之|同理)"
IMAGE = r"^\s*(?:!\[|<img)"
MOJIBAKE = "Ã[\u0080-\u00BF]|â€|ï»¿|\uFFFD"

# Kinds of items that a caption may name, in Chinese and in English, and their numbers.
CAPTION_KINDS = "定理|引理|命题|推论|例|示例|定义|公理|公设|注|注释|评注"
CAPTION_KINDS_EN = ("Definition", "Theorem", "Lemma", "Corollary", "Proposition", "Example", "Remark", "Assumption", "Algorithm", "Axiom")
CAPTION_NUMBER = r"(\d+(?:\s*\.\s*\d+){0,3}(?:\s*-\s*\d+)?)"
FIGURE_REFERENCE = r"(?:图|(?:[Ff]igure|[Ff]ig\.))\s*([0-9]+(?:[.\-][0-9]+){1,2})"

# Raised and lowered signs and the letters that they stand for, in the same order.
RAISED, RAISED_AS = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻ⁿⁱᵉᵒᵖᵃᵇᶜᵈˢᵗʳᵏˡᵐᵘᵛˣʸᶻᵍʰʷᶠʲ", "0123456789+-nieopabcdstrklmuvxyzghwfj"
LOWERED, LOWERED_AS = "₀₁₂₃₄₅₆₇₈₉₊₋ₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓ", "0123456789+-aehijklmnoprstuvx"

# Headings and labelled numbers of a scanned section, and what introduces a list of notes.
SOURCE_HEAD_GLUED = r"^(?:§|8)(\d+)\.(\d+)"
SOURCE_HEAD_PLAIN = r"^(\d+)\.(\d+)\s+\S"
SOURCE_HEAD_SHORT = r"§\s*(\d+)\.(\d+)"
SOURCE_NUMBER = r"(\d{1,3})\.(\d{1,3})[.\-·](\d{1,3})"
SOURCE_LABEL = "定义|定理|引理|命题|推论|例|公理|练习|评注|准则|Definition|Theorem|Lemma|Proposition|Corollary|Example|Axiom|Exercise|Remark"
SUMMARY_HEAD = r"^##\s*§\s*(\d+)\.(\d+)"
NOTES = r"(?i)(注解|注释|注[：:]|备注|说明|Remarks?|Notes?|Comments?)"
PAREN_NUMBER = r"[（(](\d{1,3})[)）]"
SECTION_ONLY_ENTRY = r"\*\*(定义|定理|引理|推论|命题)\s*(\d{1,2})\.(\d{1,3})"
TEXT_LABELS = (("定义", r"定义[（(]"), ("定理", r"定理[（(]"), ("引理", r"引.{0,2}理[（(]"))

# Fixed values of the two-level scan: items, section heads (a section sign may be read as S or 8) and examples.
SCAN_ITEM = r"(定义|定理|引理|推论|命题)\s*(\d+)\s*[.·]\s*(\d+)"
SCAN_SECTION = r"^(§|S|8)?\s*(\d+)\s*[.·]\s*(\d+)\s*([^\d.·].{0,30})"
SCAN_EXAMPLE = r"^例\s*(\d+)"

# Commands that spacing broke, and what they are meant to be (``$1`` is the first group).
BROKEN = (
    (r"\\in\s+t([^a-zA-Z]|$)", r"\\int$1"), (r"\\in\s+fty", r"\\infty"), (r"\\in\s+f([^a-zA-Z]|$)", r"\\inf$1"), (r"\\qquad\s*([a-zA-Z])", r"\\qquad $1"),
    (r"\\quad\s*([a-zA-Z])", r"\\quad $1"), (r"\\widetilde\s+P", r"\\widetilde P"), (r"\\frac(\d)([a-zA-Z]\{)", r"\\frac{$1}$2"),
)

# What ends a proof.
PROOF_END = "□|∎|证毕"
