import pytest

from estrato.config import LakeConfig


def test_paths_follow_root_environment_layer_table():
    cfg = LakeConfig(root="s3a://lake/", environment="dev")
    assert cfg.path("bronze", "uf") == "s3a://lake/dev/bronze/uf/"
    assert cfg.path("quality", "validation_results") == "s3a://lake/dev/quality/validation_results/"


@pytest.mark.parametrize("layer", ["silver", "gold", "quality", "monitoring"])
def test_derived_layers_may_be_replaced(layer):
    cfg = LakeConfig(root="/lake")
    cfg.require_rebuildable(cfg.path(layer, "uf"))


@pytest.mark.parametrize(
    "path",
    [
        "/lake/dev/bronze/uf/",
        "/lake/dev/",
        "/lake/",
        "/lake/dev/silver/",
        "/lake/prod/silver/uf/",
        "/lake/dev/silver/../bronze/uf/",
        "/elsewhere/dev/silver/uf/",
    ],
)
def test_everything_else_is_refused(path):
    with pytest.raises(ValueError, match="refusing"):
        LakeConfig(root="/lake").require_rebuildable(path)


def test_unknown_settings_layers_and_tables_are_errors():
    with pytest.raises(ValueError, match="unknown settings"):
        LakeConfig.from_mapping({"root": "/lake", "bucket": "b"})
    with pytest.raises(ValueError, match="unknown layer"):
        LakeConfig(root="/lake").path("platinum", "uf")
    with pytest.raises(ValueError, match="not a table"):
        LakeConfig(root="/lake").path("silver", "a/b")
    with pytest.raises(ValueError, match="root"):
        LakeConfig(root="")
    with pytest.raises(ValueError, match="databases"):
        LakeConfig(root="/lake", databases={"bronze": "b"})


def test_the_clock_has_the_configured_offset():
    assert LakeConfig(root="/l").now().isoformat().endswith("-03:00")
