from tablemend.functions.rules import apply_rule, register_rule
from tablemend.functions.text import below, has_text, is_safe_path, named, quoted

__all__ = ["apply_rule", "below", "has_text", "is_safe_path", "named", "quoted", "register_rule"]
