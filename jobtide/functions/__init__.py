"""Column -> Column functions. No function here runs an action."""
