"""Pure helpers: names, special values, ordinals."""
