"""The contract on streams."""
