"""Write commands, their validation, previews and execution, and what the engine says it can do."""
