"""Reading, writing and staging of the business tables."""
