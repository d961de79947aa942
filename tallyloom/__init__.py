"""Business documents from relational tables, as DataFrame plans."""
