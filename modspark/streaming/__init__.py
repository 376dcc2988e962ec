"""The batch plans as streams."""
