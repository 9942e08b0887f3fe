"""The default detection and masking policy, and the built-in patterns."""

from __future__ import annotations

# The default policy. Entities, thresholds, context words, patterns, strategies and
# their parameters must stay as they are for results to agree with the expected ones.
DEFAULT_POLICY = {
    "enabled": True,
    "entities": {
        "person": {
            "entity_type": "PERSON",
            "enabled": True,
            "confidence_threshold": 0.7,
            "context_words": ["name", "person", "individual", "customer"],
            "anonymization_strategy": "custom",
            "anonymization_params": {"lambda": "mask_person"},
        },
        "email": {
            "entity_type": "EMAIL_ADDRESS",
            "enabled": True,
            "confidence_threshold": 0.8,
            "context_words": ["email", "e-mail", "mail", "contact"],
            "anonymization_strategy": "custom",
            "anonymization_params": {"lambda": "mask_email"},
        },
        "phone": {
            "entity_type": "PHONE_NUMBER",
            "enabled": True,
            "confidence_threshold": 0.7,
            "context_words": ["phone", "telephone", "mobile", "cell", "number"],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 7, "from_end": True},
        },
        "ssn": {
            "entity_type": "US_SSN",
            "enabled": True,
            "confidence_threshold": 0.9,
            "context_words": ["ssn", "social security", "social security number"],
            "anonymization_strategy": "redact",
        },
        "credit_card": {
            "entity_type": "CREDIT_CARD",
            "enabled": True,
            "confidence_threshold": 0.7,
            "context_words": [
                "credit card", "card number", "payment", "visa", "mastercard", "card", "cc", "creditcard",
            ],
            "regex_patterns": [
                {"name": "visa_dash_format", "regex": r"\b4\d{3}-\d{4}-\d{4}-\d{4}\b", "score": 0.9},
                {"name": "mastercard_dash_format", "regex": r"\b5\d{3}-\d{4}-\d{4}-\d{4}\b", "score": 0.9},
                {"name": "amex_dash_format", "regex": r"\b3[0-9]\d{2}-\d{4}-\d{4}-\d{4}\b", "score": 0.9},
                {"name": "generic_dash_format", "regex": r"\b\d{4}-\d{4}-\d{4}-\d{4}\b", "score": 0.8},
            ],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 12, "from_end": True},
        },
        "location": {
            "entity_type": "LOCATION",
            "enabled": True,
            "confidence_threshold": 0.6,
            "context_words": ["address", "location", "city", "state", "country"],
            "anonymization_strategy": "custom",
            "anonymization_params": {"lambda": "mask_location"},
        },
        "date": {
            "entity_type": "DATE_TIME",
            "enabled": False,
            "confidence_threshold": 0.7,
            "context_words": ["date", "time", "when", "birthday", "created_at", "born", "dob"],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 6, "from_end": True},
        },
        "ip_address": {
            "entity_type": "IP_ADDRESS",
            "enabled": True,
            "confidence_threshold": 0.8,
            "context_words": ["ip", "ip address", "address", "host"],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 8, "from_end": True},
        },
        "url": {
            "entity_type": "URL",
            "enabled": True,
            "confidence_threshold": 0.7,
            "context_words": ["url", "website", "link", "domain"],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 10, "from_end": True},
        },
        "organization": {
            "entity_type": "ORG",
            "enabled": False,
            "confidence_threshold": 0.7,
            "context_words": ["company", "organization", "org", "corporation"],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 6, "from_end": True},
        },
        "money": {
            "entity_type": "MONEY",
            "enabled": False,
            "confidence_threshold": 0.8,
            "context_words": ["money", "amount", "price", "cost", "salary"],
            "anonymization_strategy": "mask",
            "anonymization_params": {"masking_char": "*", "chars_to_mask": 4, "from_end": True},
        },
        "bank_account": {
            "entity_type": "IBAN_CODE",
            "enabled": False,
            "confidence_threshold": 0.9,
            "context_words": ["bank account", "account number", "iban", "routing"],
            "anonymization_strategy": "redact",
        },
    },
    "anonymization": {
        "default_strategy": "mask",
        "default_replacement": "<REDACTED>",
        "mask_char": "*",
        "mask_from_end": True,
        "hash_type": "sha256",
        "encryption_key": None,
    },
    "nlp": {"supported_languages": ["en"]},
}

# Column names never inspected, and the suffix with the same effect.
ID_COLUMNS = ("user_id", "id", "uuid", "guid", "key", "pk")
ID_SUFFIX = "_id"

# Scores, context words and street words of the street-address patterns. Edges are look-arounds,
# because \b depends on what the JVM takes for a letter; words before the street word are a loop over a class and
# parts after it a possessive group, because java.util.regex recurses into other repeated groups. No two loops next to
# each other share a character, so that a search is linear in the text.
STREET_WORDS = "St|Ave|Rd|Dr|Ln|Blvd|Way|Ct|Pl|Street|Avenue|Road|Drive|Lane|Boulevard"
ADDRESS_CONTEXT = ("address", "location", "street", "avenue", "road")
BEFORE, AFTER = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"
ADDRESS_PATTERNS = (
    (
        "full_address",
        rf"{BEFORE}\d+\s+[A-Za-z][A-Za-z\s]*\s(?:{STREET_WORDS}){AFTER}(?:,[A-Za-z\s]+)*+",
        0.8,
    ),
    ("street_address", rf"{BEFORE}\d+\s[A-Za-z\s]+(?:{STREET_WORDS}){AFTER}", 0.7),
    ("address_with_city", rf"{BEFORE}\d+\s[A-Za-z\s]++,[A-Za-z\s]++,[A-Za-z\s]+", 0.8),
)
