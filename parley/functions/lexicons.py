"""Word lists, phrases and templates that results depend on, in their natural order."""

NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

NEGATIVE = (
    "cannot", "can't", "unable to", "don't want", "problem", "issue", "error", "failed", "broken", "frustrated", "angry", "terrible", "bad", "wrong",
    "mistake", "unauthorized", "stolen", "lost", "complaint", "disappointed", "delay", "slow", "chargeback", "double charge", "fraud", "scam",
)
POSITIVE = ("thank", "thanks", "great", "excellent", "happy", "good", "love", "wonderful", "appreciate", "helpful", "perfect", "glad", "solved", "fixed")
URGENT = (
    "asap", "urgent", "immediately", "right away", "compromised", "hacked", "stolen", "unauthorized", "fraud", "double charge", "cancel", "refund", "error",
    "lost my", "blocked", "suspended", "locked out",
)
HIGH_INTENTS = ("cancel_order", "refund", "unauthorized_charge", "reset_password", "account_blocked", "security_issue")
MEDIUM_INTENTS = ("change_address", "invoice", "track_order", "shipping", "payment_method")
ESCALATION = (
    "speak to a manager", "human", "representative", "person", "supervisor", "agent", "call me", "phone number", "escalate", "ombudsman", "complain",
    "threaten", "sue", "legal",
)
ILLEGAL = ("fraud", "scam", "unauthorized")
CONDITIONS = ("if", "when", "unless", "but", "although", "except")
HELP_MARKERS = ("step", "1.", "2.", "please", "assist", "contact", "support", "help", "thank")
STOP_WORDS = tuple(
    "i me my myself we our ours you your he him she her it its they them what which who this that these those am is are was were be been being have has had"
    " do does did a an the and but if or as until while of at by for with about against between into through during before after above below to from up"
    " down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not only"
    " own same so than too very s t can will just should now".split()
)

SHORT_TEMPLATES = ("how to {}", "{} help", "need help with {}", "can you do {}")
LONG_PREFIXES = (
    "Hi there, sorry to bother you, but I was wondering if you could help me. ",
    "Hello customer support team, I hope you are having a nice day. I have an issue. ",
    "Excuse me, I'm writing this message because I need some assistance with a problem. ",
    "Can you please help me? I have been trying to figure this out on my own but I am stuck. ",
)
LONG_SUFFIXES = (
    " Thank you very much in advance for your assistance!",
    " Please reply as soon as you can. I appreciate your support.",
    " I look forward to hearing from you. Thanks!",
    " It would be great if you could resolve this for me.",
)
SYNONYMS = (
    ("cancel", "stop"), ("purchase", "order"), ("puchase", "order"), ("assistance", "help"), ("assist", "help"), ("problem", "issue"),
    ("difficulties", "problems"), ("affordable", "cheap"), ("afford", "pay for"),
)
OPENINGS = (
    "I've understood you have a question",
    "I've been informed that you have a question",
    "I can sense that you're seeking assistance",
    "I understood that you need assistance",
    "I'm sensitive to the fact that you're facing",
    "Of course, I'm here to assist you",
    "I pick up what you're putting down",
    "I comprehend the urgency",
    "I catch on to the fact that",
    "I'm on the same wavelength",
)
NEW_OPENINGS = (
    "I would be glad to help you",
    "I am ready to assist you",
    "I understand your request completely and will assist you",
    "Let's get this sorted out for you right away",
    "I appreciate you bringing this to our attention. Let me help you",
)
ADJACENT_KEYS = {
    "a": "qwsz", "b": "vghn", "c": "xdfv", "d": "ersfxc", "e": "wsdr", "f": "rtgvcd", "g": "tyhbvf", "h": "yujnbg", "i": "ujko", "j": "uikmnh",
    "k": "ijlm", "l": "okp", "m": "njk", "n": "bhjm", "o": "iklp", "p": "ol", "q": "wa", "r": "edft", "s": "wedxza", "t": "rfgy", "u": "yhji",
    "v": "cfgb", "w": "qase", "x": "zsdc", "y": "tghu", "z": "asx",
}
#: The default of a parameter; any text may be given.
SYSTEM_PROMPT = "You are a helpful and professional customer support assistant."
