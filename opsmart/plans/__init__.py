"""The reports and curated tables, one module per business area."""
