"""Fixed values.

These must equal the values the original support pipeline uses for results to
match (keyword rules, fallback texts, prompt wording, special token ids and
sequence lengths).  They are stated here once, in their natural order.
"""

# --- fixed values: keyword lexicon, in declared (priority) order -------------
STOCK_LEXICON: list[tuple[str, list[str]]] = [
    ("cancel_order", ["cancel", "order", "cancellation"]),
    ("track_order", ["track", "where", "status", "order"]),
    ("payment_issue", ["payment", "charge", "bill", "refund", "money"]),
    ("contact_customer_service", ["speak", "contact", "service", "representative", "human"]),
    ("account", ["account", "login", "password", "sign in", "profile"]),
    ("delivery", ["delivery", "shipping", "arrive", "when", "package"]),
    ("complaint", ["complaint", "unhappy", "dissatisfied", "problem", "issue"]),
    ("refund", ["refund", "money back", "return"]),
]
FALLBACK_INTENT = "general"

# --- fixed values: texts ------------------------------------------------------
EMPTY_MESSAGE_NOTICE = "Please enter a question or select one from the examples."
MODEL_PROMPT_PREFIX = "Answer the following customer support question in a helpful and friendly way: "
QUERY_PLACEHOLDER = "{query}"
NO_PLACEHOLDER_PREFIX = "Regarding your question about "
NO_PLACEHOLDER_SEPARATOR = ": "
RESPONSE_INFO_FORMAT = "Response time: %.2f seconds"

DEFAULT_BANK_TEMPLATES: list[str] = [
    "I understand you're asking about {query}. Let me help you with that.",
    "Thank you for your question about {query}. Here's what I can tell you.",
    "I'd be happy to assist you with your inquiry about {query}.",
    "Regarding your question about {query}, here's some information that might help.",
]

DEFAULT_QUESTIONS: list[str] = [
    "How do I cancel my order?",
    "Where is my package?",
    "I want a refund for my purchase",
    "How can I contact customer service?",
    "I need to change my shipping address",
    "My payment was declined",
    "I want to track my order",
    "How do I reset my password?",
    "I received the wrong item",
    "When will my order arrive?",
]
DEFAULT_CATEGORIES: list[str] = [
    "ACCOUNT", "ORDER", "REFUND", "CONTACT", "INVOICE",
    "PAYMENT", "FEEDBACK", "DELIVERY", "SHIPPING", "SUBSCRIPTION",
]
DEFAULT_INTENTS: list[str] = [
    "cancel_order", "track_order", "payment_issue",
    "contact_customer_service", "change_shipping_address",
    "get_refund", "complaint", "delivery_period",
]

# --- fixed values: sizes and special token ids ---------------------------------
BANK_PER_INTENT = 5
BANK_GENERAL_SIZE = 20
PREVIEW_ROWS = 5
SAMPLE_QUESTIONS = 10
SAMPLE_TRAIN_ROWS = 100
BATTERY_MODEL_PREFIX = 5
TOP_VALUES = 10
LOW_CARDINALITY = 20
HISTOGRAM_BINS = 50
MAX_INPUT_LENGTH = 128
MAX_TARGET_LENGTH = 512
CLASSIFIER_LENGTH = 128
CLASSIFIER_TRAIN_ROWS = 1000
CLASSIFIER_VALID_ROWS = 200
BOS_ID = 0
PAD_ID = 1
EOS_ID = 2
UNK_ID = 3  # our choice: the original vocabulary is not available
VOCAB_SIZE = 50265
LABEL_IGNORE_ID = -100
SEED = 42
TEST_SHARE = 0.1
VAL_SHARE = 0.1
