"""marl: a Spark-native engine for conversation logs, documents and the statements drawn from them.

The core (`functions`, `operators`, `sources`, `plans`, `streaming`) never imports the optional `llm` subpackage.
"""
