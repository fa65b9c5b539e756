"""Schemas of the relations that the engine reads and writes."""

MESSAGES = "array<struct<role: string, content: string>>"
EXAMPLE = f"messages {MESSAGES}"
REMOVED = f"example struct<messages: {MESSAGES}>, reason string, global_idx bigint"
VERDICT = "ok boolean, remove array<int>, reasons map<string, string>"
REPLY = "raw string, status string, attempts int"
TOPIC = "topic_idx int, topic string, count int"
SOURCE = "path string, split string, config string, column string, probability double"
EFFICIENCY = "label string, chars int, tokens int, ratio double, assessment string"
