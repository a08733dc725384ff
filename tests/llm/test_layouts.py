"""Lists in which an element is not an object have no known layout."""

from chronolens.llm import chat


def test_lists_of_other_values_are_unknown():
    layouts = chat.Layouts()
    assert layouts.select({"messages": ["hi", "there"]}) is None
    assert layouts.select({"messages": [{"role": "user", "content": "x"}, "hi"]}) is None
    for record in ({"messages": []}, {"messages": [{"role": "user", "content": "x"}]}):
        assert layouts.select(record).name == "messages"
