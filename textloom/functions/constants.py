"""Character classes, marks, word lists, templates. They are data, not logic."""

# Fixed value: the characters Python treats as white space.
WHITESPACE = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# Fixed value: word characters of the word/punctuation splitter.
WORD_CHARS = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"

# Fixed value: punctuation marks that stand alone in the BERT splitter.
BERT_PUNCT = r"!-/:-@\[-`{-~\p{P}"

# Punctuation replaced by the white-space tokenizers.
CJK_MARKS = "，。、；！？「」『』【】（）《》…"
LATIN_MARKS = ",.;?!"

# Fixed value: CJK ideograph blocks that get blanks around them.
CJK_CHARS = (
    r"\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}"
    r"\x{2b740}-\x{2b81f}\x{2b820}-\x{2ceaf}\x{f900}-\x{faff}\x{2f800}-\x{2fa1f}"
)

# Special tokens, in id order, of the two trainers.
SPECIALS_LIKELIHOOD = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
SPECIALS_FREQUENCY = ["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]"]

# Fixed value: text fields of a corpus line, in reading order.
CORPUS_FIELDS = ["text", "content", "body", "abstract", "title", "document"]

# Fixed value: candidate names of a text column, best first.
TEXT_COLUMNS = ["text", "sentence", "content", "abstract", "title"]

# Patterns of biomedical terms, matched against the lowered token.
DOMAIN_PATTERNS = [
    r".*(?:osis|itis|emia|uria|pathy|ology|ectomy|oma|genesis|lysis|trophy|plasia|gram|scopy)$",
    r".*(?:ine|ase|ide|ium|acid|sterol|peptide|protein|enzyme)$",
    r".*(?:cardio|neuro|gastro|hepato|nephro|pulmo|dermo|osteo|myo|arthro).*",
    r"^(?:anti|hyper|hypo|pre|post|inter|intra|extra|sub|trans|micro|macro|multi).*",
    r".*(?:DNA|RNA|gene|genom|transcript|chromo|allele).*",
    r".*(?:cell|cellular|mitoch|nuclei|cyto|membrane|receptor).*",
    r".*(?:immun|antibod|antigen|lymph|leuko|cytokine).*",
    r".*(?:tumor|cancer|malign|benign|metasta|neoplas).*",
    r".*(?:therapeutic|pharmac|clinical|dosage|treatment).*",
]

# Keywords of biomedical terms, searched in the lowered token.
DOMAIN_KEYWORDS = [
    "protein", "gene", "cell", "dna", "rna", "enzyme", "hormone", "virus", "bacteria",
    "infection", "disease", "treatment", "therapy", "clinical", "medical", "patient",
    "diagnosis", "symptom", "syndrome", "disorder", "cancer", "tumor", "immune",
    "blood", "tissue", "organ", "molecular", "genetic", "biological", "biochemical",
    "physiological", "pathological", "pharmaceutical", "metabolism", "neuron",
    "cardiac", "pulmonary", "renal", "hepatic", "gastric", "dermal", "skeletal",
]

# Common English function words; callers may pass a longer list.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out "
    "on off over under again further then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very can will just should now"
).split()

# The ten class names of the multi-label report.
CLASS_NAMES = [f"class_{i}" for i in range(10)]

# Difficulty levels of the translation report.
LEVELS = ["easy", "medium", "hard"]

# Wording of the hybrid retrieval prompt.
PROMPT_ROLE = (
    'You are a professional linguist and translator, expert at translating the low-resource language "Zhuang" '
    'into fluent, natural "Chinese".\n\n'
)
PROMPT_VOCABULARY = (
    "--- Related Vocabulary ---\n"
    "The following are the most likely words involved in this sentence and their translations. "
    "Please refer to and use them when translating:\n"
)
PROMPT_EXAMPLES = (
    "--- Translation Examples ---\n"
    "Here are some examples most similar to the sentence to be translated. "
    "Please imitate their style and structure:\n"
)
PROMPT_RULE = (
    "--- Related Grammar Rules ---\n"
    "To better understand the sentence structure, please refer to this highly relevant grammar rule:\n"
    "Grammar description: "
)
PROMPT_RULE_END = "\n\n--- Background knowledge ends ---\n\n"
PROMPT_TASK = "--- Translation Task ---"
PROMPT_TASK_STEPS = (
    "\nPlease use all the above information comprehensively and follow these steps to complete the task: "
    "Step 1, analyze sentence structure; Step 2, combine vocabulary and examples to understand word meanings and "
    "style; Step 3, generate the final translation.\n"
    "Please only output the final Chinese translation result without including any analysis process.\n\n"
)
PROMPT_TASK_PLAIN = (
    "\nPlease use all the information provided above comprehensively to translate the following Zhuang sentence "
    "into Chinese.\n"
    "Please strictly follow the requirements and only output the final Chinese translation result without any "
    "additional explanations, tags, or prefixes.\n\n"
)
PROMPT_SENTENCE = 'Zhuang sentence to be translated: "'

# Wording of the review prompt.
REVIEW_HEAD = (
    "You are a top-level Zhuang translation proofreading expert. Here is a Zhuang sentence, related background "
    "knowledge, and a preliminary translation version.\n---\n【Zhuang Original】: \""
)
REVIEW_ANSWER = "\n【Preliminary Translation】: \""
REVIEW_TASK = (
    "\"\n---\nPlease strictly based on the 【Background Knowledge】, review whether the 【Preliminary Translation】 "
    "has any inaccuracies or awkwardness. If the preliminary translation is perfect, please repeat it directly. "
    "If there are errors, please directly output your corrected final version.\n"
    "Your task is to output the most perfect translation, so please only output the final Chinese sentence without "
    "any analysis and explanation."
)

# Wording of the example-and-dictionary prompt.
DICT_PROMPT_HEAD = (
    "# Please follow the examples, refer to the given vocabulary and grammar, translate the Zhuang sentence into "
    "Chinese.\n\n"
)
DICT_PROMPT_ASK = "## Please translate the following Zhuang sentence into Chinese: "
DICT_PROMPT_WORDS = "## In the above sentence, "
DICT_PROMPT_WORD = ('the Zhuang word "', '" may translate to ', " in Chinese;\n")
DICT_PROMPT_ANSWER = "## Therefore, the complete Chinese translation of this Zhuang sentence is:"
DICT_PROMPT_RULES = "## Relevant grammar rules:\n"
RULE_DESCRIPTION = "Grammar description: "
RULE_EXAMPLES = "Examples:\n"
RULE_EXAMPLE = ("  - Zhuang: ", "\n    Chinese: ", "\n")
