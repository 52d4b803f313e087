"""Column functions: lenient parsing, text helpers, money, and the Lambert-93 conversion."""
