"""Fixed values.

Everything in this file is data that results depend on letter by letter: label
domains, keyword lists, prompt and reply texts, patterns and number formats.
They are the published values of the ticket problem and are stated as they are.
"""

# --- fixed values: whitespace -------------------------------------------------
# The characters Python's str.split()/strip() treat as whitespace, once as a
# character list and once as the body of a regex class (valid in Java and RE2).
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# --- fixed values: label domains ----------------------------------------------
TICKET_TYPES = ("Incident", "Request", "Problem", "Change")
TICKET_QUEUES = (
    "Technical Support",
    "Product Support",
    "Customer Service",
    "IT Support",
    "Billing and Payments",
    "General Inquiry",
    "Returns and Exchanges",
    "Sales",
)
TICKET_PRIORITIES = ("high", "medium", "low")
STATUS_PENDING = "pending_review"
STATUS_APPROVED = "approved"
STATUS_REJECTED = "rejected"
DEFAULT_PRIORITY = "medium"
DEFAULT_LABEL = "Unknown"
DEFAULT_REVIEWER = "Admin"
TAG_COLUMNS = tuple(f"tag_{i}" for i in range(1, 9))

# --- fixed values: routing keywords -------------------------------------------
# (label, words); the first row with a hit wins, the default applies otherwise.
PRIORITY_RULES = (
    ("high", ("urgent", "critical", "emergency", "down", "breach")),
    ("low", ("question", "inquiry", "information", "thanks")),
)
PRIORITY_DEFAULT = "medium"
TYPE_RULES = (
    ("Incident", ("error", "bug", "issue", "problem", "not working")),
    ("Problem", ("slow", "performance", "investigate")),
    ("Change", ("upgrade", "enhance", "feature", "change")),
)
TYPE_DEFAULT = "Request"
QUEUE_RULES = (
    ("Billing and Payments", ("billing", "payment", "invoice", "refund")),
    ("Product Support", ("product", "feature", "specification")),
    ("Customer Service", ("account", "login", "password")),
)
QUEUE_DEFAULT = "Technical Support"
ROUTING_CONFIDENCE = 0.85

# --- fixed values: reply texts ------------------------------------------------
REPLY_SUBJECT_CHARS = 50
REPLY_TEMPLATES = {
    "high": """Dear Customer,

Thank you for reaching out to us. We understand the urgency of your issue regarding {subject}.

Our team has received your ticket and is treating this as a high-priority matter. We are actively investigating the situation and will provide you with an update within the next 2 hours.

In the meantime, please ensure:
1. All relevant information has been documented
2. Any temporary workarounds are in place if possible
3. Key stakeholders are informed

We will contact you at your registered phone number if we need additional information.

Best regards,
Technical Support Team""",
    "medium": """Dear Customer,

Thank you for contacting our support team regarding {subject}.

We have received your request and our team is reviewing the details. You can expect a response within 24 hours.

If you have any additional information that might help us resolve your inquiry more quickly, please reply to this ticket.

Best regards,
Support Team""",
    "low": """Dear Customer,

Thank you for reaching out to us about {subject}.

We have logged your inquiry and our team will review it shortly. For general inquiries, our typical response time is 2-3 business days.

In the meantime, you might find helpful information in our FAQ section at [support.example.com/faq].

Best regards,
Customer Service Team""",
}

# --- fixed values: instruction texts ------------------------------------------
RESPONSE_INSTRUCTION = """You are a professional customer support agent. Based on the customer's ticket below, generate a helpful, professional, and empathetic response.

Guidelines:
- Address the customer's specific concerns
- Provide clear and actionable solutions
- Maintain a professional yet friendly tone
- Use placeholders like <name>, <tel_num>, <email> for personal information"""
MULTI_TASK_INSTRUCTION = """You are an intelligent customer support system. Analyze the ticket below and:
1. Classify it by type, queue, and priority
2. Generate a professional response

Available classifications:
- Type: Incident, Request, Problem, Change
- Queue: Technical Support, Product Support, Customer Service, IT Support, Billing and Payments, General Inquiry, Returns and Exchanges, Sales
- Priority: high, medium, low"""
CLASSIFICATION_INSTRUCTION = """Classify this customer support ticket into the following categories:
- Type: Incident, Request, Problem, Change
- Queue: Technical Support, Product Support, Customer Service, IT Support, Billing and Payments, General Inquiry, Returns and Exchanges, Sales
- Priority: high, medium, low

Output format: Type: X | Queue: Y | Priority: Z"""

# --- fixed values: prompt layouts ---------------------------------------------
CHAT_LAYOUT = (
    "<|im_start|>system\n{instruction}<|im_end|>\n"
    "<|im_start|>user\n{input}<|im_end|>\n"
    "<|im_start|>assistant\n"
)
PLAIN_LAYOUT = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:
{instruction}

### Input:
{input}

### Response:
"""

# --- fixed values: patterns of rendered outputs -------------------------------
TYPE_LABEL = "Type:"
QUEUE_LABEL = "Queue:"
PRIORITY_LABEL = "Priority:"
RESPONSE_LABEL = "Response:"
URL_CHARS = r"[a-z0-9!$-_]"
MANIFEST_FORMAT = "alpaca"
MANIFEST_SPLITS = ("train", "val", "test")

# --- fixed values: experiment names -------------------------------------------
# (substring, value), first hit wins
NAME_RANKS = (("rank16", 16), ("rank32", 32), ("rank128", 128))
NAME_RANK_DEFAULT = 64
NAME_KINDS = (("lr", "learning_rate"), ("epoch", "epochs"), ("warmup", "warmup"), ("rank", "lora_rank"))
NAME_BASELINE_SUFFIX = "lora"
NAME_KIND_DEFAULT = "other"
NAME_PARAMS = (
    ("lr1e4", "LR=1e-4"),
    ("lr5e4", "LR=5e-4"),
    ("epoch5", "Epoch=5"),
    ("warmup03", "Warmup=0.03"),
    ("rank16", "Rank=16"),
    ("rank32", "Rank=32"),
    ("rank128", "Rank=128"),
)
NAME_PARAM_BASELINE = "Rank=64 (Baseline)"
NAME_PARAM_DEFAULT = "Unknown"

# --- fixed values: goals and advice -------------------------------------------
# (metric column, goal)
TARGETS = (("avg_rougeL_f", 0.40), ("priority_accuracy", 0.85), ("type_accuracy", 0.80))
# (metric column, threshold, advice)
ADVICE = (
    ("type_accuracy", 0.80, "collect more examples for rare types"),
    ("priority_accuracy", 0.75, "clarify the priority labels"),
    ("queue_accuracy", 0.70, "try hierarchical queue classification"),
    ("avg_rougeL_f", 0.30, "train longer or use a larger rank"),
)
# (lower bound is exclusive for the first, inclusive for the second)
ROUGE_L_EXCELLENT = 0.5
ROUGE_L_GOOD = 0.3
OVERFIT_GAP = 0.1
MANY_EPOCHS = 5

# --- fixed values: feature presets --------------------------------------------
TFIDF_FULL = {"max_features": 50_000, "min_df": 5, "min_token_chars": 1, "use_stop_words": True}
TFIDF_PLAIN = {"max_features": 10_000, "min_df": 1, "min_token_chars": 2, "use_stop_words": False}
VOCABULARY_SIZE = 20_000
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_TOKEN_ID = 2
SHORT_SEQUENCE = 128
LONG_SEQUENCE = 256
BLEU_EPSILON = 0.1
