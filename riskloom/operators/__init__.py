"""Generic relational operators shared by every stage."""
