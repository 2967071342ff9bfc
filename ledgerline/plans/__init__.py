"""Composition: the model graph, the end-to-end run, plan inspection."""
