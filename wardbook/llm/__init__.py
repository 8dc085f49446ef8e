"""Operators for preparing training text: near copies, repeats, quality, language, secrets, tokens, archives, chats."""
