"""Presets: the cafe and the e-commerce model, from raw tables to answers."""
