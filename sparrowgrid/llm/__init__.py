"""Training-data operators: ten corpus operations, each by its own named method.

Nothing outside this folder imports it, and it imports nothing from the rest of the library.
Every operator takes and returns DataFrames; see each module's docstring for its defined edge cases.
"""
