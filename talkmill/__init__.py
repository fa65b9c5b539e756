"""talkmill: prepares conversational and plain-text corpora for language-model training on Spark."""
