"""The pipelines and the rule set, put together from the operators."""
