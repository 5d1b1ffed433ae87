import pytest

from pathloom.plans.templates import id_columns, normalise, parse_template, plan_groups

COW = "Device.Farm.Yard.Pen.{i}.Cow.{i}."
STATION = "Device.Garden.Bed.{i}.Plant.{i}."
TEMPLATES = [
    "Device.Fence.Gate.{i}.Side",
    "Device.Sheds.Shed.{i}.Shelf.Tool.{i}.Grip",
    "Device.Farm.Yard.Pen.{i}",
    COW + "Alive",
    COW + "Colour",
    COW + "Insect.{i}",
    COW + "Insect.{i}.Kind",
    COW + "Insect.{i}.LegsTimeRemaining",
    "Device.PlotInfo.Soil.Damp",
    "Device.PlotInfo.Sort",
    "Device.Garden.AcreCount",
    (STATION + "Alive", "PlantAlive"),
    STATION + "Height",
]


def aliases(groups):
    return sorted(sorted(t.alias for t in g.templates) for g in groups)


def test_parse():
    template = parse_template(COW + "Status.Alive")
    assert template.collections == (("Device", "Farm", "Yard", "Pen"), ("Cow",))
    assert template.leaf == ("Status", "Alive")
    assert (template.alias, template.depth, template.parts, template.root) == ("Alive", 2, 9, "Device.Farm")


@pytest.mark.parametrize("path", ["{i}.A", "A.{i}.{i}.B", "A..B", ""])
def test_bad_templates(path):
    with pytest.raises(ValueError):
        parse_template(path)


def test_normalise_sorts_and_drops_instance_templates():
    assert [t.path for t in normalise(["B.y", "A.P.{i}", "A.P.{i}.x"])] == ["A.P.{i}.x", "B.y"]
    with pytest.raises(ValueError):
        normalise(["A.P.{i}"])
    with pytest.raises(ValueError):
        normalise(["A.x", ("A.x", "other")])


def test_ancestors_groups():
    groups = plan_groups(TEMPLATES, "ancestors")
    assert aliases(groups) == [
        ["AcreCount", "Height", "PlantAlive"],
        ["Alive", "Colour", "Kind", "LegsTimeRemaining"],
        ["Damp", "Sort"],
        ["Grip"],
        ["Side"],
    ]
    assert id_columns(groups) == [
        ["Pen", "Cow", "Insect"],
        ["Gate"],
        ["Bed", "Plant"],
        [],
        ["Shed", "Tool"],
    ]


def test_siblings_groups():
    assert aliases(plan_groups(TEMPLATES, "siblings")) == [
        ["AcreCount", "Height", "PlantAlive"],
        ["Alive", "Colour"],
        ["Damp", "Sort"],
        ["Grip"],
        ["Kind", "LegsTimeRemaining"],
        ["Side"],
    ]


def test_sibling_collections_never_share_rows():
    groups = plan_groups(["R.s.A.{i}.n", "R.s.A.{i}.X.{i}.p", "R.s.A.{i}.Y.{i}.q", "R.s.total"])
    assert aliases(groups) == [["n", "p", "total"], ["n", "q", "total"]]


def test_first_template_of_a_group_is_the_deepest():
    group = plan_groups(TEMPLATES, "ancestors")[0]
    assert [t.alias for t in group.templates] == ["Kind", "LegsTimeRemaining", "Alive", "Colour"]


def test_bad_mode():
    with pytest.raises(ValueError):
        plan_groups(TEMPLATES, "cousins")


def test_column_clashes():
    twice = plan_groups(["R.s.A.{i}.B.A.{i}.x"])
    with pytest.raises(ValueError):
        id_columns(twice)
    assert id_columns(twice, {"R.s.A.{i}.B.A": "inner"}) == [["A", "inner"]]
    with pytest.raises(ValueError):
        id_columns(plan_groups(["R.s.A.{i}.A"]))
    with pytest.raises(ValueError):
        id_columns(plan_groups(["R.s.A.{i}.B.x", "R.s.A.{i}.C.x"]))
